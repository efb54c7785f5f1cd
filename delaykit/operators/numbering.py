"""Running numbers over a whole table, without gathering it in one task."""

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.session import new_work_dir

# Rows of a task are told apart by the low bits of ``monotonically_increasing_id``.
TASK_SHIFT = 33


def numbered(df: DataFrame, order, column: str = "number") -> DataFrame:
    """``df`` with ``column``: 0, 1, 2 and so on in the given order.

    The rows are range-sorted once and stored below the shared working folder with their place in the task's
    range; the sizes of the ranges before, one number for each task, are what is added to it. ``order`` should
    be total: what it leaves equal is numbered in the order of the sort. Equal keys are spread over ranges only
    as far as ``order`` tells them apart.
    """
    spark = df.sparkSession
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    place = f"__{column}_place"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    path = f"{new_work_dir(spark)}/numbered"
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    task, low = F.shiftright(place, TASK_SHIFT), F.col(place).bitwiseAND(F.lit((1 << TASK_SHIFT) - 1))
    sizes = sorted((r["task"], r["count"]) for r in rows.groupBy(task.alias("task")).count().collect())
    before = [0, *accumulate(size for _, size in sizes)]
    offsets = [(number, offset) for (number, _), offset in zip(sizes, before)]
    starts = spark.createDataFrame(offsets, f"`{place}_task` bigint, `{place}_start` bigint")
    placed = rows.join(starts, task == F.col(f"{place}_task"))
    return placed.select(*df.columns, (F.col(f"{place}_start") + low).alias(column))
