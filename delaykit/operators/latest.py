"""One row per key, by aggregates that combine before the shuffle.

A window over the key would gather all rows of a hot key in one task; ``max``
and ``min`` of a struct keep one row per key and map task instead.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: list[str], order_cols: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order = []
    for i, name in enumerate(order_cols):
        # Rows without an order value lose against all others, for max and for min.
        known = F.col(name).isNotNull() if pick is F.max else F.col(name).isNull()
        order += [known.alias(f"k{i}"), F.col(name).alias(f"o{i}")]
    # Remaining columns break ties, so a rerun gives the same row.
    ranked = F.struct(*order, F.struct(*rest).alias("row"))
    return (
        df.groupBy(*keys)
        .agg(pick(ranked).alias("__best"))
        .select(*keys, *[F.col(f"__best.row.{c}").alias(c) for c in rest])
        .select(df.columns)
    )


def latest_per_key(df: DataFrame, keys: list[str], *order_cols: str) -> DataFrame:
    return _one_per_key(df, keys, list(order_cols), F.max)


def first_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    return _one_per_key(df, keys, [order_col], F.min)


def merge_latest(current: DataFrame, updates: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """State of a keyed table after ``updates``: the latest row per key.

    At equal ``order_col`` an update replaces the current row. Both sides go
    through one aggregation, there is no join.
    """
    flag = "__update"
    both = current.withColumn(flag, F.lit(0)).unionByName(updates.withColumn(flag, F.lit(1)))
    return _one_per_key(both, keys, [order_col, flag], F.max).drop(flag)
