"""Per-request lookups as set-at-a-time joins.

No join carries a broadcast hint. A stored side below
``spark.sql.autoBroadcastJoinThreshold`` is broadcast by the planner, a derived
side once adaptive execution has measured it, and beyond that the join shuffles
and splits hot partitions of the request side, which is always the left one.
The right side has one row per key, so no key multiplies rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.operators.aggregates import fleet_totals
from delaykit.operators.latest import first_per_key, latest_per_key

WAIT_LIMIT = "120 seconds"


def with_distance(df: DataFrame, distances: DataFrame, default: float | None = 0.0) -> DataFrame:
    """Add ``Distance`` by (Origin, Dest); ``default`` for an unknown route.

    ``distances`` is a keyed table: one row per (Origin, Dest).
    """
    known = distances.select("Origin", "Dest", F.col("Distance").cast("double").alias("__distance"))
    joined = df.join(known, ["Origin", "Dest"], "left")
    distance = F.col("__distance") if default is None else F.coalesce("__distance", F.lit(float(default)))
    kept = [c for c in df.columns if c != "Distance"]
    return joined.select(*kept, distance.alias("Distance"))


def request_status(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """``OK`` and the prediction once a response with the id exists, else ``WAIT``."""
    answers = latest_per_key(responses.select("UUID", "Timestamp", "Prediction"), ["UUID"], "Timestamp")
    answers = answers.select("UUID", "Prediction", F.lit("OK").alias("__status"))
    return (
        requests.select("UUID")
        .join(answers, "UUID", "left")
        .select("UUID", F.coalesce("__status", F.lit("WAIT")).alias("status"), "Prediction")
    )


def stored_status(requests: DataFrame, stored: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """``request_status`` over responses that are kept bucketed by ``UUID``, one row each, and ``fresh`` ones since.

    Requests and fresh responses are dealt to the buckets of the stored table, which is read in place: its rows
    are not shuffled, however many there are. Of a stored and a fresh response the later one counts, the fresh
    one at the same time.
    """
    kept = stored.select("UUID", F.col("Timestamp").alias("__at"), F.col("Prediction").alias("__prediction"), F.lit("OK").alias("__kept"))
    found = requests.select("UUID").join(kept, "UUID", "left")
    if fresh is None:
        return found.select("UUID", F.coalesce("__kept", F.lit("WAIT")).alias("status"), F.col("__prediction").alias("Prediction"))
    newest = latest_per_key(fresh.select("UUID", "Timestamp", "Prediction"), ["UUID"], "Timestamp")
    both = found.join(newest.withColumn("__fresh", F.lit("OK")), "UUID", "left")
    later = F.col("__fresh").isNotNull() & (
        F.col("__kept").isNull() | F.col("__at").isNull() | F.coalesce(F.col("Timestamp") >= F.col("__at"), F.lit(False))
    )
    return both.select(
        "UUID",
        F.coalesce("__kept", "__fresh", F.lit("WAIT")).alias("status"),
        F.when(later, F.col("Prediction")).otherwise(F.col("__prediction")).alias("Prediction"),
    )


def await_responses(requests: DataFrame, responses: DataFrame, timeout: str = WAIT_LIMIT) -> DataFrame:
    """Requests answered within ``timeout``, or timed out.

    Request ids are unique. Of several responses with one id the first within the time counts; those before
    the request or after its limit do not.
    """
    answers = responses.select("UUID", F.col("Timestamp").alias("answered_at"), "Prediction").alias("r")
    asked = requests.select("UUID", "Timestamp").alias("q")
    limit = F.col("q.Timestamp") + F.expr(f"INTERVAL {timeout}")
    in_time = (F.col("q.UUID") == F.col("r.UUID")) & F.col("r.answered_at").between(F.col("q.Timestamp"), limit)
    first = F.min(F.when(F.col("r.answered_at").isNotNull(), F.struct("r.answered_at", "r.Prediction"))).alias("first")
    found = asked.join(answers, in_time, "left").groupBy("q.UUID", "q.Timestamp").agg(first)
    return status_columns(found, F.col("first.answered_at"))


def status_columns(found: DataFrame, answered_at: Column) -> DataFrame:
    """Status, time and class from the ``first`` answer of each request, null for none."""
    return found.select(
        "UUID",
        "Timestamp",
        F.when(F.col("first").isNotNull(), "ANSWERED").otherwise("TIMEOUT").alias("status"),
        answered_at.alias("answered_at"),
        F.col("first.Prediction").alias("Prediction"),
    )


def carrier_profile(airlines: DataFrame, fleets: DataFrame) -> DataFrame:
    """Rows of a fleet with its size and the carrier's summary, which may be missing."""
    summary = fleet_totals(fleets).join(airlines, F.col("Carrier") == F.col("CarrierCode"), "left")
    return fleets.join(summary.withColumnRenamed("Carrier", "__carrier"), F.col("Carrier").eqNullSafe(F.col("__carrier"))).drop("__carrier")


def match_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Each request with its first response; requests without one are left out."""
    first = first_per_key(responses.select("UUID", "Timestamp", "Prediction"), ["UUID"], "Timestamp")
    first = first.select("UUID", F.col("Timestamp").alias("answered_at"), "Prediction")
    return requests.join(first, "UUID", "inner")
