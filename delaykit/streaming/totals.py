"""Totals that a stream keeps up to date in a keyed table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaykit.operators.aggregates import fleet_totals
from delaykit.sources.tables import read_keyed, stream_writer, upsert_keyed
from delaykit.streaming.scoring import MICRO_BATCH

TOTAL = "total"
MONTH, FLEET, MANUFACTURER = ["Year", "Month"], ["Carrier", "TailNum"], ["Manufacturer"]


def start_totals(
    rows: DataFrame, keys: list[str], root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Count rows per key for as long as the stream runs.

    Each micro-batch writes the totals it changed, late rows included, as a batch of the keyed table at
    ``root``. The state is one number for each key; rows of a hot key are counted before they are shuffled. A
    restart from ``checkpoint`` goes on with the same totals; a new checkpoint needs a new ``root``.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(TOTAL))

    def on_batch(changed: DataFrame, batch_id: int) -> None:
        upsert_keyed(changed, root, batch_id, stream_writer(changed))

    return (
        counted.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": MICRO_BATCH}))
        .foreachBatch(on_batch)
        .start()
    )


def read_totals(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Current total per key. Totals only grow, so the largest is the latest, whatever the writers' clocks say."""
    return read_keyed(spark, root, keys, TOTAL)


def months_of(spark: SparkSession, root: str) -> DataFrame:
    """``flights_by_month`` from a stream's totals by ``MONTH``."""
    return read_totals(spark, root, MONTH).withColumnRenamed(TOTAL, "total_flights").orderBy(*MONTH)


def fleets_of(spark: SparkSession, root: str) -> DataFrame:
    """``fleet_totals`` from a stream's totals by ``FLEET``, which has each airplane of a carrier once."""
    return fleet_totals(read_totals(spark, root, FLEET).filter(F.col("TailNum").isNotNull()))


def manufacturers_of(spark: SparkSession, root: str) -> DataFrame:
    """``manufacturer_totals`` from a stream's totals by ``MANUFACTURER``."""
    return read_totals(spark, root, MANUFACTURER).withColumnRenamed(TOTAL, "Total").orderBy(F.desc("Total"), *MANUFACTURER)
