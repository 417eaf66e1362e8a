"""Helpers shared by the operators: shared folder, checkpoints, and column expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.session import ship_by_value

ship_by_value(__name__)

# The letters that ASCII-only lower-casing touches, and the bytes that end a word.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. A local session
    without that setting gets a temporary folder; a cluster without it is refused."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='regflow-llm-')}"
    context.setCheckpointDir(folder)
    return folder


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder, without its lineage."""
    spark = frame.sparkSession
    root = shared_root(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return frame.checkpoint(eager=True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_root(spark)}/llm-{label}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written once as Parquet in the shared folder and read again. For wide or
    large rows, where compressed columns are smaller than a checkpoint's rows."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole_text(name: str) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def ids_and_texts(frame: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the two columns an operator reads, named `id` and `text`, so that further
    columns of any name cannot clash with its own."""
    return frame.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), whole_text(f"`{text_col}`").alias("text")
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pieces(batches, column: str = "text", most: int = 4 << 20):
    """Record batches cut into pieces of about `most` bytes of `column`, one row at least, so
    that a task's memory follows the longest row and not the batch."""
    for batch in batches:
        sizes = batch.column(column).nbytes / max(1, batch.num_rows)
        step = max(1, int(most / max(1.0, sizes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
