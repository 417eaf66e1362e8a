"""Month labels and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regflow.functions.text import strip
from regflow.schema import MONTHS


_NUMBER_OF = "map(" + ", ".join(f"'{name}', {i}" for i, name in enumerate(MONTHS, 1)) + ")"
_LABELS = "array(" + ", ".join(f"'{name}'" for name in MONTHS) + ")"
_NAME_OF = "map(" + ", ".join(f"{i}, '{name}'" for i, name in enumerate(MONTHS, 1)) + ")"


def month_number(label: Column) -> Column:
    """1-12 for an upper-case label, else NULL."""
    return F.try_element_at(F.expr(_NUMBER_OF), label)


def month_name(number: Column) -> Column:
    return F.try_element_at(F.expr(_NAME_OF), number)


def month_label(label: Column) -> Column:
    """Trimmed, upper-case month label; an unknown one raises."""
    clean = F.upper(strip(label))
    return F.when(label.isNull() | clean.isin(*MONTHS), clean).otherwise(
        F.raise_error(F.concat(F.lit("no such month: "), label)).cast("string")
    )


def report_date_text(text: Column) -> Column:
    """`1/JUN/2026` -> `01/06/2026`; a bad date raises in ANSI mode."""
    return F.date_format(F.to_date(text, "d/MMM/yyyy"), "dd/MM/yyyy")


REPORT_DATE_SQL = "to_date(trim(date), 'd/M/yyyy')"
TRY_REPORT_DATE_SQL = "try_to_date(trim(date), 'd/M/yyyy')"


def report_date(text: Column) -> Column:
    """Day/month/year text to a date; a bad date raises in ANSI mode."""
    return F.to_date(F.trim(text), "d/M/yyyy")


def try_report_date(text: Column) -> Column:
    return F.try_to_date(F.trim(text), "d/M/yyyy")


def month_of(date: Column) -> Column:
    """Upper-case month label of a date."""
    return F.try_element_at(F.expr(_LABELS), F.month(date))


def previous_month_start(date: Column) -> Column:
    return F.add_months(F.trunc(date, "month"), -1)
