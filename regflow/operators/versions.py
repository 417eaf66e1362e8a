"""Stored tables whose partitions are replaced together.

A load writes its partitions into a folder of its own, `load=<id>/<partition>=<value>`, which
nobody reads yet. One small file in `_versions` then names, for every partition of the table, the folder
that holds it. Readers go by the newest such file, so they see a load as a whole or not at
all, whatever fails on the way. The file is put in its place by a rename that refuses to
replace another one, so of two loads that start from the same version the second fails.

A plain folder of partitions, as Spark writes it, is version 0 of such a table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = "_versions"
_NULL = "__HIVE_DEFAULT_PARTITION__"


class TableChanged(RuntimeError):
    """Another load changed the table in the meantime; nothing of this one can be seen."""


@dataclass(frozen=True)
class Version:
    number: int
    #: Partition folder, such as `period=2026-06-01` -> the load folder that holds it, or ""
    #: for the table's own folder.
    parts: dict[str, str]


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]


def read_json(spark: SparkSession, path: str):
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value) -> None:
    """A small file that appears whole, and never in place of another: FileExistsError."""
    folder, name = path.rsplit("/", 1)
    system, draft = _place(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    goal = hadoop.Path(path)
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(draft, goal, options)
    except Exception as error:
        system.delete(draft, False)
        if system.exists(goal):
            raise FileExistsError(path) from error
        raise


def part_name(partition: str, value) -> str:
    return f"{partition}={_NULL if value is None else quote(str(value), safe=' -_.,+()')}"


def current(spark: SparkSession, path: str, partition: str) -> Version:
    """The newest version; version 0, without partitions, before the first load."""
    root = path.rstrip("/")
    numbers = [int(n[:-5]) for n in names_in(spark, f"{root}/{VERSIONS}") if n[:-5].isdigit() and n.endswith(".json")]
    if numbers:
        newest = max(numbers)
        return Version(newest, read_json(spark, f"{root}/{VERSIONS}/{newest:010d}.json")["parts"])
    plain = [n for n in names_in(spark, root) if n.startswith(f"{partition}=")]
    return Version(0, {n: "" for n in plain})


def read(
    spark: SparkSession,
    path: str,
    partition: str,
    schema: T.StructType | str | None = None,
    version: Version | None = None,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """A version of the table, the newest by default; empty before the first load.

    With `only`, the partition folders to read, no other one is listed. Without a
    schema that of the files holds, and the table must exist.
    """
    root = path.rstrip("/")
    version = version or current(spark, root, partition)
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = version.parts if only is None else {n: version.parts[n] for n in only if n in version.parts}
    own = [f"{root}/{name}" for name, load in wanted.items() if not load]
    loads = [f"{root}/{load}/{name}" for name, load in wanted.items() if load]
    frames = []
    for paths, extra in ((own, []), (loads, [T.StructField("load", T.StringType())])):
        if paths:
            reader = spark.read.option("basePath", root)
            if kind is not None:
                reader = reader.schema(T.StructType([*kind.fields, *extra]))
            frames.append(reader.parquet(*paths).drop("load"))
    if not frames:
        if kind is not None:
            return spark.createDataFrame([], kind)
        if version.number or version.parts:
            raise FileNotFoundError(f"no partitions to read at {path}")
        return _plain(spark, root)
    if kind is not None:
        frames = [frame.select(*(f"`{f.name}`" for f in kind.fields)) for frame in frames]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)


def _plain(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no table at {path}") from error


def new_load() -> str:
    return f"load={uuid.uuid4().hex}"


def write_load(frame: DataFrame, path: str, partition: str, load: str) -> list[str]:
    """Write partitions into a load folder that nothing names yet; returns their names."""
    spark, goal = frame.sparkSession, f"{path.rstrip('/')}/{load}"
    # The rebalance hint writes few files per partition value and splits a large one.
    frame.hint("rebalance", partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(partition).parquet(goal)
    return [n for n in names_in(spark, goal) if n.startswith(f"{partition}=")]


def drop_load(spark: SparkSession, path: str, load: str) -> None:
    if not load.startswith("load="):
        raise ValueError(f"not a load folder: {load}")
    system, place = _place(spark, f"{path.rstrip('/')}/{load}")
    system.delete(place, True)


def commit(spark: SparkSession, path: str, version: Version, kept: Version | None = None) -> Version:
    """Make a version the newest. Load folders that neither it nor `kept`, the version before,
    names are superseded for the second time and go."""
    root = path.rstrip("/")
    name = f"{root}/{VERSIONS}/{version.number:010d}.json"
    try:
        write_json(spark, name, {"parts": version.parts})
    except FileExistsError as error:
        raise TableChanged(f"version {version.number} of {path} is there already; run the load again") from error
    if kept is not None and kept.number > 1:
        before = read_json(spark, f"{root}/{VERSIONS}/{kept.number - 1:010d}.json")["parts"]
        for load in set(before.values()) - set(kept.parts.values()) - set(version.parts.values()) - {""}:
            drop_load(spark, root, load)
    return version


def replace(
    frame: DataFrame,
    path: str,
    partition: str,
    base: Version,
    replaced: Iterable[str] | None = None,
    check: Callable[[str], None] | None = None,
) -> Version:
    """The version after `base` with the partitions of `frame` in place of `replaced`, by
    default of all. A failure before the last step leaves the table as it was; so does one
    of `check`, which is given the folder of the rows before anybody can see them."""
    spark, load = frame.sparkSession, new_load()
    try:
        written = write_load(frame, path, partition, load)
        if check is not None:
            check(f"{path.rstrip('/')}/{load}")
        gone = set(base.parts if replaced is None else replaced) | set(written)
        parts = {n: at for n, at in base.parts.items() if n not in gone} | dict.fromkeys(written, load)
        return commit(spark, path, Version(base.number + 1, parts), base)
    except BaseException:
        drop_load(spark, path, load)
        raise


def _digests(frame: DataFrame, partition: str, sign: int) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in frame.columns]
    hashes = [F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)") * sign for seed in (1, 2)]
    return frame.select(
        F.col(f"`{partition}`").alias("part"), F.lit(sign).alias("n"), hashes[0].alias("a"), hashes[1].alias("b")
    )


def changed_partitions(before: DataFrame, after: DataFrame, partition: str) -> list:
    """Partition values whose rows differ, whatever their order: one aggregation, combined on the
    map side, of row counts and of sums of two hashes, those of `before` taken as negative."""
    both = _digests(before, partition, -1).unionByName(_digests(after.select(before.columns), partition, 1))
    sums = both.groupBy("part").agg(*(F.sum(c).alias(c) for c in ("n", "a", "b")))
    return [row.part for row in sums.filter("n <> 0 or a <> 0 or b <> 0").select("part").collect()]


def rewrite_changed(
    spark: SparkSession,
    path: str,
    partition: str,
    schema: T.StructType | str,
    change: Callable[[DataFrame], DataFrame],
    only: Iterable[str] | None = None,
) -> list[str]:
    """Change the rows of a stored table; returns the partition folders that were rewritten.

    `change` must keep rows in their partition. Partitions whose rows stay equal
    are not written, so a second run writes nothing. `only` limits what is read.
    """
    base = current(spark, path, partition)
    before = read(spark, path, partition, schema, base, only)
    values = changed_partitions(before, change(before), partition)
    names = [part_name(partition, value) for value in values]
    if names:
        rows = change(read(spark, path, partition, schema, base, names)).select(before.columns)
        replace(rows, path, partition, base, names)
    return sorted(names)


def sweep(spark: SparkSession, path: str, hours: float = 48) -> list[str]:
    """Remove load folders that the two newest versions do not name and that are older than
    `hours`, such as those of killed jobs; returns their names."""
    root = path.rstrip("/")
    numbers = sorted(int(n[:-5]) for n in names_in(spark, f"{root}/{VERSIONS}") if n[:-5].isdigit())
    named: set[str] = set()
    for number in numbers[-2:]:
        named |= set(read_json(spark, f"{root}/{VERSIONS}/{number:010d}.json")["parts"].values())
    system, place = _place(spark, root)
    oldest = (time.time() - hours * 3600) * 1000
    gone = []
    for status in system.listStatus(place) if numbers else []:
        name = status.getPath().getName()
        if name.startswith("load=") and name not in named and status.getModificationTime() <= oldest:
            drop_load(spark, root, name)
            gone.append(name)
    return sorted(gone)
