"""Document collections behind a ``format`` argument."""

from pyspark.sql import DataFrame, SparkSession

from delaykit.operators.filters import for_day


def read_requests(
    spark: SparkSession,
    source: str | None,
    iso_date: str,
    fmt: str = "mongodb",
    options: dict | None = None,
    schema=None,
    inclusive: bool = True,
    column: str = "Timestamp",
) -> DataFrame:
    """One day of requests; the time range is left to the source where it can filter."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return for_day(reader.load(source) if source else reader.load(), iso_date, inclusive, column)


def append_results(
    df: DataFrame, sink: str | None, fmt: str = "mongodb", options: dict | None = None
) -> None:
    """Append result records; an empty batch adds no record."""
    writer = df.write.format(fmt).mode("append").options(**(options or {}))
    if sink:
        writer.save(sink)
    else:
        writer.save()
