"""Small fixtures: report workbooks, trees and fact rows."""

from pathlib import Path

from regflow.catalog.adapter import workbook_bytes
from regflow.schema import FUEL_HEADERS, MAPPING_HEADERS, Grain

# Fuels that the base report does not have.
ABSENT = {
    "HCNG",
    "HYDROGEN(ICE)",
    "FLEX-FUEL(BIO-DIESEL)",
    "PETROL(E20)/HYBRID/CNG",
    "PETROL/HYBRID/CNG",
}
FIVE_ABSENT_COLUMNS = {
    "hcng", "hydrogen_ice", "flex_fuel_bio_diesel", "petrol_e20_hybrid_cng", "petrol_hybrid_cng",
}


def report(labels, extra=(), gap=True, title="Report"):
    """Rows of a report: 31 fuels numbered in order and the total at its usual place."""
    present = [h for h in FUEL_HEADERS if h not in ABSENT]
    # Blank columns stand for absent fuels, so that the total stays at position 38.
    blanks = [None] * (36 - len(present)) if gap else []
    head = [None, None, *present, *blanks, None, *extra]
    body = [
        ["Total", label, *map(str, range(1, len(present) + 1)), *blanks, "1,032", *["9"] * len(extra)]
        for label in labels
    ]
    return [[title], [], [], head, *body]


def save(root: Path, folders: str, rows, name="reportTable.xlsx"):
    path = root / folders / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(rows if isinstance(rows, bytes) else workbook_bytes(rows))
    return path


def mapping_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in MAPPING_HEADERS))


MOTOR_CAR = ("MOTOR CAR", "Passenger", "Car", "Private")


def fact_rows(spark, grain: Grain, rows):
    """Fact frame from dicts; columns that a dict leaves out are NULL."""
    columns = grain.columns
    data = [tuple(row.get(c) for c in columns) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns)).selectExpr(
        "*", "timestamp'2026-07-01 00:00:00' as inserted_at"
    )


def as_dicts(frame, *columns):
    return [row.asDict() for row in (frame.select(*columns) if columns else frame).collect()]


def plan_text(frame):
    """Physical plan after the query ran, as AQE left it."""
    frame.write.format("noop").mode("overwrite").save()
    executed = frame._jdf.queryExecution().executedPlan()
    frame.collect()
    return executed.toString()
