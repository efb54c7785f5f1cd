"""Category indexes as a keyed table, for columns with more values than a driver should hold.

The indexes are those of ``ml.index_categories``: by falling frequency, ties alphabetical.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.operators.numbering import numbered


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, idx) of each known value of each column.

    Values are counted in one pass, which combines them before its shuffle, and ranked by one range sort; a
    column's ranks begin where its first value stands.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = (
        df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = numbered(counted, ["column_name", F.desc("n"), "value"])
    first = ranked.groupBy("column_name").agg(F.min("number").alias("first"))
    return ranked.join(first, "column_name").select(
        "column_name", "value", (F.col("number") - F.col("first")).cast("double").alias("idx")
    )


def with_category_indexes(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``<column>_index``; null and unknown values get one index more than the column has.

    The dictionary side is unique by value; a small one is broadcast by the planner, a large one is shuffled and
    adaptive execution splits hot values of ``df``. The number of values of each column is one row.
    """
    sizes = dictionary.groupBy().pivot("column_name", columns).agg(F.count(F.lit(1)))
    known = {r: n or 0 for r, n in sizes.first().asDict().items()}
    for name in columns:
        index = f"{name}_index"
        own = dictionary.filter(F.col("column_name") == name).select(F.col("value").alias(f"__{index}"), F.col("idx").alias(index))
        found = df.join(own, F.col(name).cast("string") == F.col(f"__{index}"), "left").drop(f"__{index}")
        df = found.withColumn(index, F.coalesce(F.col(index), F.lit(float(known[name]))))
    return df
