"""Counts that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def parse_count(text: Column) -> Column:
    """Strip commas and cast to INT; other text, `5.0` included, raises in ANSI mode."""
    return _plain(text).cast("int")


def parse_count_sql(name: str) -> str:
    """`parse_count` of a named column as SQL text.

    Wide projections are given to Spark as text: one call per column instead of one per
    expression node.
    """
    return f"cast(replace(`{name}`, ',', '') as int)"


def try_parse_count_sql(name: str) -> str:
    plain = f"replace(`{name}`, ',', '')"
    return f"case when {plain} rlike '^ *[+-]?[0-9]+ *$' then try_cast({plain} as int) end"


def try_parse_count(text: Column) -> Column:
    """As `parse_count`, with NULL for text that is not a whole number."""
    plain = _plain(text)
    return F.when(plain.rlike("^ *[+-]?[0-9]+ *$"), plain.try_cast("int"))
