"""Parquet and JSON-lines datasets."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from delaykit.operators.copies import sort_whole
from delaykit.operators.counts import metrics_of
from delaykit.schemas import FEATURES

DAY_COLUMN = "iso_date"
#: Rows of a JSON file, at most.
FILE_ROWS = 1_000_000


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """On-time table; only the columns a query uses are read."""
    return spark.read.parquet(path)


def read_features(spark: SparkSession, path: str, schema: StructType = FEATURES) -> DataFrame:
    """JSON lines with a fixed schema, compressed or not (bz2 files are split)."""
    return spark.read.schema(schema).json(path)


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with an inferred schema, which costs one more pass; see ``conform``."""
    return spark.read.json(path)


def describe(df: DataFrame) -> DataFrame:
    """One row: number of rows and the column names."""
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "columns", F.array(*[F.lit(c) for c in df.columns])
    )


def export_json(
    df: DataFrame, path: str, order_by=None, compression: str | None = None, file_rows: int = FILE_ROWS
) -> None:
    """Replace a JSON dataset.

    With ``order_by`` the files hold consecutive ranges of the order and keep it when read by file name. A file
    has ``file_rows`` rows at most, so compressed ones need not be of a kind that readers can split.
    """
    writer = (sort_whole(df, order_by) if order_by else df).write.mode("overwrite").option("maxRecordsPerFile", file_rows)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def write_daily(df: DataFrame, root: str, iso_date: str) -> None:
    """Replace one day of a dataset partitioned by day, and no other day; without rows the day becomes empty."""
    day = date.fromisoformat(iso_date[:10]).isoformat()
    df.write.mode("overwrite").json(f"{root}/{DAY_COLUMN}={day}")


def read_daily(spark: SparkSession, root: str, iso_date: str, schema: StructType) -> DataFrame:
    """One day of such a dataset; other days' files are not opened."""
    day = date.fromisoformat(iso_date[:10])
    dated = StructType([*schema.fields, StructField(DAY_COLUMN, DateType(), True)])
    return spark.read.schema(dated).json(root).filter(F.col(DAY_COLUMN) == F.lit(day)).drop(DAY_COLUMN)


def days_between(first: str, last: str) -> list[date]:
    """The days from ``first`` to ``last``, both included."""
    start, end = date.fromisoformat(first[:10]), date.fromisoformat(last[:10])
    return [start + timedelta(days=n) for n in range((end - start).days + 1)]


def write_days(
    df: DataFrame, root: str, first: str, last: str, column: str = "Timestamp", inclusive: bool = True
) -> list[date]:
    """Replace each day from ``first`` to ``last`` by its rows of ``df``, in one job; returns the days with rows.

    A row belongs to the day of ``column``; ``inclusive`` puts the first instant of a day into the day before as
    well, as ``for_day`` does. Other days stay as they are; days without rows become empty, once the others are
    written.
    """
    days = days_between(first, last)
    value, day = F.col(column), F.col(column).cast("date")
    kind = df.schema[column].dataType
    low, high = F.lit(days[0].isoformat()).cast(kind), F.lit((days[-1] + timedelta(days=1)).isoformat()).cast(kind)
    kept = df.filter((value >= low) & ((value <= high) if inclusive else (value < high)))
    own = F.array(day)
    if inclusive:
        own = F.when(value == day.cast(kind), F.array(day, F.date_sub(day, 1))).otherwise(own)
    dated = kept.withColumn(DAY_COLUMN, F.explode(own)).filter(F.col(DAY_COLUMN).between(F.lit(days[0]), F.lit(days[-1])))
    seen = Observation("days")
    # Few files for each day; adaptive execution cuts a large day over many tasks.
    counted = dated.observe(seen, F.array_join(F.collect_set(F.col(DAY_COLUMN).cast("string")), ",").alias("days")).hint("rebalance", F.col(DAY_COLUMN))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY_COLUMN).json(root)
    with_rows = sorted(date.fromisoformat(d) for d in (metrics_of(seen).get("days") or "").split(",") if d)
    _empty_days(df.sparkSession, root, [d for d in days if d not in set(with_rows)])
    return with_rows


def _empty_days(spark: SparkSession, root: str, days: list[date]) -> None:
    for day in days:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{DAY_COLUMN}={day.isoformat()}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            files.delete(path, True)


def read_days(spark: SparkSession, root: str, first: str, last: str, schema: StructType) -> DataFrame:
    """The days from ``first`` to ``last`` of such a dataset, with their day; other days' files are not opened."""
    days = days_between(first, last)
    dated = StructType([*schema.fields, StructField(DAY_COLUMN, DateType(), True)])
    return spark.read.schema(dated).json(root).filter(F.col(DAY_COLUMN).between(F.lit(days[0]), F.lit(days[-1])))
