"""Delay-like views over the test tables, as DataFrames and as SQL text.

No join carries a hint: the planner broadcasts the sides it knows to be small,
adaptive execution the ones it measures as small, and it splits hot partitions.
Stored tables are joined directly, because their size is known to the planner,
and orders get their destination before they meet the line items, so that the
largest table is never shuffled by customer.
"""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hhmm(minute):
    hour = F.lpad(F.expr(f"({minute}) div 60").cast("string"), 2, "0")
    return F.concat(hour, F.lpad(F.expr(f"({minute}) % 60").cast("string"), 2, "0"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    origin = nation.select(F.col("n_nationkey").alias("o_nationkey"), F.col("n_name").alias("Origin"))
    dest = nation.select(F.col("n_nationkey").alias("d_nationkey"), F.col("n_name").alias("Dest"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(dest, F.col("c_nationkey") == F.col("d_nationkey"))
        .select("o_orderkey", "c_nationkey", "Dest")
    )
    items = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origin, F.col("s_nationkey") == F.col("o_nationkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    day = F.col("l_shipdate").cast("date")
    line = F.col("l_linenumber")
    dep_minute = "1 + (l_orderkey * 7 + l_linenumber * 61) % 1440"
    arr_minute = "1 + (l_orderkey * 7 + l_linenumber * 61 + l_partkey) % 1440"
    return items.select(
        (F.col("l_orderkey") % 2000).cast("string").alias("FlightNum"),
        day.cast("string").alias("FlightDate"),
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("DayofMonth"),
        (F.weekday(day) + 1).alias("DayOfWeek"),
        F.concat("l_returnflag", "l_linestatus").alias("Carrier"),
        F.concat(F.lit("N"), F.col("l_suppkey").cast("string")).alias("TailNum"),
        "Origin",
        "Dest",
        (F.abs(F.col("s_nationkey") - F.col("c_nationkey")) * 100 + line).cast("double").alias("Distance"),
        F.when(line != 7, F.col("l_quantity") - 10).alias("DepDelay"),
        F.when(line < 6, 2 * F.col("l_quantity") - 40).alias("ArrDelay"),
        _hhmm(dep_minute).alias("CRSDepTime"),
        _hhmm(arr_minute).alias("CRSArrTime"),
    )


def airplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation")
    joined = supplier.join(part, F.col("s_suppkey") == F.col("p_partkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        F.concat(F.lit("N"), F.col("s_suppkey").cast("string")).alias("TailNum"),
        F.col("s_name").alias("Owner"),
        F.col("n_name").alias("OwnerState"),
        F.col("p_brand").alias("Manufacturer"),
        F.col("p_type").alias("Model"),
        (F.lit(1980) + F.col("p_size")).alias("ManufacturerYear"),
        F.col("p_partkey").cast("string").alias("SerialNumber"),
        F.split("p_name", " ")[1].alias("EngineManufacturer"),
        F.col("p_name").alias("EngineModel"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = flights(spark, sf_dir).select(F.col("Carrier").alias("CarrierCode")).distinct()
    return codes.filter(F.col("CarrierCode") != "AF").withColumn(
        "Name", F.concat(F.lit("Carrier "), F.col("CarrierCode"))
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_type")
    text = lambda number: number.cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt-"), text(event)).alias("UUID"),
        F.when(kind != "error", F.concat(F.lit("NATION_"), text(F.col("user_id") % 25))).alias("Origin"),
        F.concat(F.lit("NATION_"), text(event % 25)).alias("Dest"),
        F.when((kind == "signup") & (event % 7 == 0), "").otherwise("AF").alias("Carrier"),
        F.when(event % 11 != 0, F.col("ts").cast("date").cast("string")).alias("FlightDate"),
        F.when(event % 5 != 0, (event % 60 - 10).cast("double")).alias("DepDelay"),
        F.when(event % 3 != 0, text(event % 2000)).alias("FlightNum"),
        F.col("ts").alias("Timestamp"),
    )


def all_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt-"), event.cast("string")).alias("UUID"),
        (event % 4).cast("double").alias("Prediction"),
        (F.col("ts") + F.make_dt_interval(secs=(event % 240))).alias("Timestamp"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to the requests of three event types; the others get none."""
    event = F.col("event_id")
    answered = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "view", "click"))
    return answered.select(
        F.concat(F.lit("evt-"), event.cast("string")).alias("UUID"),
        (event % 4).cast("double").alias("Prediction"),
        (F.col("ts") + F.make_dt_interval(secs=(event % 240))).alias("Timestamp"),
    )


#: Second answers: which requests have them, seconds from the request or from the first answer, what is added to the class.
REPEATS = [(6, 0, "asked", -5, 20), (4, 1, "answered", 7, 10), (10, 3, "answered", -3, 30), (14, 5, "answered", 0, 40)]


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``responses`` with some that come before their request, repeated ones, and some at the same time."""
    first = responses(spark, sf_dir).withColumn("e", F.expr("substring(UUID, 5)").cast("bigint"))
    asked = F.col("Timestamp") - F.make_dt_interval(secs=F.col("e") % 240)
    given = [F.struct("Prediction", "Timestamp", F.lit(True).alias("given"))]
    for by, rest, since, seconds, more in REPEATS:
        at = (asked if since == "asked" else F.col("Timestamp")) + F.expr(f"INTERVAL '{seconds}' SECOND")
        given.append(
            F.struct((F.col("Prediction") + more).alias("Prediction"), at.alias("Timestamp"), (F.col("e") % by == rest).alias("given"))
        )
    each = F.explode(F.filter(F.array(*given), lambda x: x["given"]))
    return first.select("UUID", each.alias("a")).select("UUID", "a.Prediction", "a.Timestamp")


def stored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with the request fields, under the stored names."""
    asked = requests(spark, sf_dir).select("UUID", "Origin", "Dest", "Carrier", "FlightDate")
    answered = responses(spark, sf_dir)
    return answered.join(asked, "UUID").select(
        F.col("UUID").alias("uuid"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("dest"),
        F.col("Carrier").alias("carrier"),
        F.col("FlightDate").alias("flight_date"),
        F.col("Prediction").alias("prediction"),
        F.col("Timestamp").alias("timestamp"),
    )


# The same views as SQL.

FLIGHTS_SQL = """
flights AS (
  SELECT CAST(l_orderkey % 2000 AS VARCHAR) AS "FlightNum",
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "FlightDate",
         CAST(year(l_shipdate) AS INTEGER) AS "Year",
         CAST(month(l_shipdate) AS INTEGER) AS "Month",
         CAST(day(l_shipdate) AS INTEGER) AS "DayofMonth",
         CAST(isodow(l_shipdate) AS INTEGER) AS "DayOfWeek",
         l_returnflag || l_linestatus AS "Carrier",
         'N' || l_suppkey AS "TailNum",
         sn.n_name AS "Origin",
         cn.n_name AS "Dest",
         CAST(abs(s_nationkey - c_nationkey) * 100 + l_linenumber AS DOUBLE) AS "Distance",
         CASE WHEN l_linenumber <> 7 THEN l_quantity - 10 END AS "DepDelay",
         CASE WHEN l_linenumber < 6 THEN 2 * l_quantity - 40 END AS "ArrDelay",
         lpad(CAST(dep // 60 AS VARCHAR), 2, '0') || lpad(CAST(dep % 60 AS VARCHAR), 2, '0') AS "CRSDepTime",
         lpad(CAST(arr // 60 AS VARCHAR), 2, '0') || lpad(CAST(arr % 60 AS VARCHAR), 2, '0') AS "CRSArrTime"
  FROM (SELECT *, 1 + (l_orderkey * 7 + l_linenumber * 61) % 1440 AS dep,
               1 + (l_orderkey * 7 + l_linenumber * 61 + l_partkey) % 1440 AS arr FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
)"""

AIRPLANES_SQL = """
airplanes AS (
  SELECT 'N' || s_suppkey AS "TailNum", s_name AS "Owner", n_name AS "OwnerState",
         p_brand AS "Manufacturer", p_type AS "Model",
         CAST(1980 + p_size AS INTEGER) AS "ManufacturerYear",
         CAST(p_partkey AS VARCHAR) AS "SerialNumber",
         split_part(p_name, ' ', 2) AS "EngineManufacturer", p_name AS "EngineModel"
  FROM supplier JOIN part ON s_suppkey = p_partkey JOIN nation ON s_nationkey = n_nationkey
)"""

AIRLINES_SQL = """
airlines AS (
  SELECT DISTINCT "Carrier" AS "CarrierCode", 'Carrier ' || "Carrier" AS "Name"
  FROM flights WHERE "Carrier" <> 'AF'
)"""

REQUESTS_SQL = """
requests AS (
  SELECT 'evt-' || event_id AS "UUID",
         CASE WHEN event_type <> 'error' THEN 'NATION_' || (user_id % 25) END AS "Origin",
         'NATION_' || (event_id % 25) AS "Dest",
         CASE WHEN event_type = 'signup' AND event_id % 7 = 0 THEN '' ELSE 'AF' END AS "Carrier",
         CASE WHEN event_id % 11 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS "FlightDate",
         CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 60 - 10 AS DOUBLE) END AS "DepDelay",
         CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 2000 AS VARCHAR) END AS "FlightNum",
         ts AS "Timestamp"
  FROM events
)"""

RESPONSES_SQL = """
responses AS (
  SELECT 'evt-' || event_id AS "UUID", CAST(event_id % 4 AS DOUBLE) AS "Prediction",
         ts + to_seconds(event_id % 240) AS "Timestamp"
  FROM events WHERE event_type IN ('purchase', 'view', 'click')
)"""

ALL_RESPONSES_SQL = """
responses AS (
  SELECT 'evt-' || event_id AS "UUID", CAST(event_id % 4 AS DOUBLE) AS "Prediction",
         ts + to_seconds(event_id % 240) AS "Timestamp"
  FROM events
)"""

ANSWERS_SQL = """
answers AS (
  SELECT * FROM responses
  UNION ALL SELECT 'evt-' || event_id, event_id % 4 + 20.0, ts - to_seconds(5) FROM events
    WHERE event_type IN ('purchase', 'view', 'click') AND event_id % 6 = 0
  UNION ALL SELECT 'evt-' || event_id, event_id % 4 + 10.0, ts + to_seconds(event_id % 240 + 7) FROM events
    WHERE event_type IN ('purchase', 'view', 'click') AND event_id % 4 = 1
  UNION ALL SELECT 'evt-' || event_id, event_id % 4 + 30.0, ts + to_seconds(event_id % 240 - 3) FROM events
    WHERE event_type IN ('purchase', 'view', 'click') AND event_id % 10 = 3
  UNION ALL SELECT 'evt-' || event_id, event_id % 4 + 40.0, ts + to_seconds(event_id % 240) FROM events
    WHERE event_type IN ('purchase', 'view', 'click') AND event_id % 14 = 5
)"""

STORED_RESPONSES_SQL = """
stored_responses AS (
  SELECT "UUID" AS uuid, "Origin" AS origin, "Dest" AS dest, "Carrier" AS carrier,
         "FlightDate" AS flight_date, "Prediction" AS prediction, r."Timestamp" AS "timestamp"
  FROM responses r JOIN requests q USING ("UUID")
)"""

DISTANCES_SQL = """
distances AS (
  SELECT "Origin", "Dest", avg("Distance") AS "Distance"
  FROM flights WHERE "Origin" <> 'NATION_3' GROUP BY "Origin", "Dest"
)"""


def with_views(body: str, *views: str) -> str:
    """SQL text with the named views in front."""
    return "WITH " + ", ".join(v.strip() for v in views) + "\n" + body.strip()
