"""Distance table loading."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.functions import first_present


def load_distances(spark: SparkSession, path: str, keep_zero: bool = False) -> DataFrame:
    """Distances from JSON lines whose field names may be capitalised or not.

    Incomplete rows are dropped. A zero distance counts as missing unless
    ``keep_zero``. Of several rows with one route the longest distance counts, so that the result has one row
    per route. Store the result with ``upsert_keyed`` on (Origin, Dest).
    """
    fields = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m"))

    def either(name, zero):
        values = [F.try_element_at("m", F.lit(n)) for n in (name, name.lower())]
        return first_present(values, keep_zero=zero)

    routes = fields.select(
        either("Origin", True).alias("Origin"),
        either("Dest", True).alias("Dest"),
        either("Distance", keep_zero).try_cast("double").alias("Distance"),
    ).dropna()
    return routes.groupBy("Origin", "Dest").agg(F.max("Distance").alias("Distance"))
