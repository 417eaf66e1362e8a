"""Small dimension tables: vehicle-class mapping and office labels."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions import text
from regflow.schema import MAPPING_HEADERS
from regflow.sources.reports import read_workbooks, scan_files, widen

OFFICE_MAP = "map<string, array<string>>"


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Sheet `Mapping` of the mapping workbook; without the workbook nothing can be mapped,
    so its absence is an error."""
    found = scan_files(spark, path)
    if found.select("path").isEmpty():
        raise FileNotFoundError(f"no mapping workbook at {path}")
    return mapping_rows(found, path)


def mapping_rows(files: DataFrame, name: str = "the mapping workbook") -> DataFrame:
    """The mapping of workbooks (path, content). One without rows would turn every class to the
    default, so that is an error."""
    rows = read_workbooks(files, sheet="Mapping", skip=0, drop_first=False)
    checked = rows.filter(
        F.when(F.col("row_no").isNotNull(), True).otherwise(
            F.raise_error(F.lit(f"no rows in sheet Mapping of {name}")).cast("boolean")
        )
    )
    return widen(checked, MAPPING_HEADERS).drop("path", "row_no")


def normalized_mapping(mapping: DataFrame) -> DataFrame:
    """Mapping with its class spelled as the report folders spell it."""
    return mapping.withColumn("Vehicle Class", text.class_key(F.col("Vehicle Class")))


def explode_office_maps(
    documents: DataFrame, column: str = "value", strict: bool = False
) -> DataFrame:
    """JSON `state -> [labels]` documents as rows (state, office_label).

    A state without offices gives no rows, nor does a corrupt document unless `strict`.
    """
    parsed = F.from_json(column, OFFICE_MAP)
    if strict:
        message = F.lit("the office file is not a JSON object of label lists")
        parsed = F.coalesce(parsed, F.raise_error(message).cast(OFFICE_MAP))
    return (
        documents.select(F.explode(parsed).alias("state", "offices"))
        .select("state", F.explode("offices").alias("office_label"))
    )


def load_office_map(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Office labels from a JSON file. An absent or corrupt file counts as empty, as when the
    file is about to be made; with `strict` it is an error."""
    try:
        return explode_office_maps(spark.read.text(path, wholetext=True), strict=strict)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if strict:
            raise FileNotFoundError(f"no office file at {path}") from error
        return spark.createDataFrame([], "state string, office_label string")


def write_office_map(offices: DataFrame, path: str) -> None:
    """Rows (state, office_label) as a folder with one JSON document, which `load_office_map` reads
    again. A map has some thousand labels, however large the reports are."""
    labels = offices.groupBy("state").agg(F.array_sort(F.collect_list("office_label")).alias("labels"))
    whole = labels.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("state", "labels"))).alias("m"))
    whole.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)
