"""Key comparison as the source's database does it.

Text keys ignore case and trailing spaces, and NULL never equals NULL. The comparable
key is a column of its own, so it is computed once per row and not again in every
comparison of a sort.

None of these joins carries a broadcast hint: Catalyst broadcasts a side only below
`spark.sql.autoBroadcastJoinThreshold`, and AQE decides again on the real shuffle size.
Above it the join shuffles by key, and AQE splits a hot key of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def computed_once(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame with these columns computed once per row, whatever is done with them later.

    A filter is pushed through a projection and then computes the columns that it names again, once for every
    time that it names them, as do the NULL checks that Spark adds to joins. It stays above
    the `inline` of a single row.
    """
    held = ", ".join(f"`{c}`" for c in columns)
    moved = frame.select(*(f"`{c}`" for c in frame.columns if c not in columns), F.expr(f"inline(array(struct({held})))"))
    return moved.select(*(f"`{c}`" for c in frame.columns))


def text_key(column: Column) -> Column:
    return F.lower(F.rtrim(column))


def key_parts(frame: DataFrame, keys: Sequence[str]) -> dict[str, str]:
    """SQL text of the comparable form of each key part."""
    types = {field.name: field.dataType for field in frame.schema}
    return {
        k: f"lower(rtrim(`{k}`))" if isinstance(types[k], StringType) else f"`{k}`" for k in keys
    }


def match_key(frame: DataFrame, keys: Sequence[str]) -> Column:
    """The comparable parts as one struct, or NULL when any part is NULL."""
    parts = key_parts(frame, keys)
    whole = " and ".join(f"`{k}` is not null" for k in keys)
    return F.expr(f"if({whole}, struct({', '.join(parts.values())}), null)")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `left` without an equal key in `right`.

    `right` is not made distinct first: its own exchange then feeds the join directly,
    which is the shape AQE can split.
    """
    keyed = left.withColumn("left_key", match_key(left, keys))
    gone = right.select(match_key(right, keys).alias("right_key"))
    kept = keyed.join(gone, F.col("left_key") == F.col("right_key"), "left_anti")
    return kept.drop("left_key")
