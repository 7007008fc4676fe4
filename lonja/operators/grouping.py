"""Group values attached to rows, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.functions.parser import counted


def attach_group(rows: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Add the aggregates of each row's group to the row.

    A window would pull a whole group into one task. Here the aggregation is combined before its shuffle,
    and the rows get the result through a join. The join key carries a hash of the key as a second
    column, so that both sides pass through an exchange of their own: AQE then sees the real sizes,
    broadcasts the aggregate if it is small, and otherwise splits the partition of a hot key over many
    tasks.
    """
    rows = counted(rows)
    spread = _spread(keys)
    groups = rows.groupBy(*keys).agg(*aggregates).withColumn("_spread", spread)
    return rows.withColumn("_spread", spread).join(groups, [*keys, "_spread"], "left").drop("_spread")


def lookup(rows: DataFrame, dimension: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join rows with a dimension that holds one row per key.

    Nothing is broadcast by hint: the planner does it when statistics or AQE's measured size allow, and
    splits hot keys otherwise (for that the dimension needs its own exchange, hence the second key).
    """
    spread = _spread(keys)
    right = dimension.withColumn("_spread", spread)
    return rows.withColumn("_spread", spread).join(right, [*keys, "_spread"], how).drop("_spread")


def _spread(keys: list[str]) -> Column:
    """One byte of a hash of the key: more would not spread better and travels with every row."""
    return F.hash(*keys).bitwiseAND(255)
