"""Every operator as a query over the test tables, with its SQL equivalent where SQL has one.

Each query reads whole tables. Wall-clock timestamps (``timestamp_ntz``) are
returned, so results do not depend on the session time zone.
"""

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from delaykit import functions as DF
from delaykit.catalogue import views as V
from delaykit.catalogue.registry import query
from delaykit.operators import aggregates, filters, lookups, ml, ordering, projections
from delaykit.operators import requests as request_ops
from delaykit.operators.latest import merge_latest
from delaykit.plans import daily
from delaykit.plans.features import derive_features, distance_job, extract_features
from delaykit.plans.requests import prepare_requests, score
from delaykit.plans.training import train_job
from delaykit.schemas import BATCH_REQUEST, FEATURES, STREAM_REQUEST
from delaykit.session import new_work_dir
from delaykit.sources import distances as distance_source
from delaykit.sources import files, models, tables, topics
from delaykit.sources.documents import read_requests
from delaykit.streaming import scoring, status

FLIGHTS = (V.FLIGHTS_SQL,)
REQUESTS = (V.REQUESTS_SQL,)
ANSWERS = (V.REQUESTS_SQL, V.RESPONSES_SQL)
STORED = (V.REQUESTS_SQL, V.RESPONSES_SQL, V.STORED_RESPONSES_SQL)
ROUTED = (V.FLIGHTS_SQL, V.DISTANCES_SQL, V.REQUESTS_SQL)

# Text shared by several SQL queries.
DEP_TS = """CAST("FlightDate" || ' ' || CASE WHEN "CRSDepTime"[1:2] = '24' THEN '23:59'
  ELSE "CRSDepTime"[1:2] || ':' || "CRSDepTime"[3:4] END || ':00' AS TIMESTAMP)"""
ARR_TS = DEP_TS.replace("CRSDepTime", "CRSArrTime")
ARR_ROLLED = f"CASE WHEN {ARR_TS} < {DEP_TS} THEN {ARR_TS} + INTERVAL 24 HOUR ELSE {ARR_TS} END"
VALID = """coalesce("Origin", '') <> '' AND coalesce("Dest", '') <> ''
  AND coalesce("Carrier", '') <> '' AND coalesce("FlightDate", '') <> ''"""
ERROR = """CASE WHEN coalesce("Origin", '') = '' THEN 'Falta el campo Origin'
  WHEN coalesce("Dest", '') = '' THEN 'Falta el campo Dest'
  WHEN coalesce("Carrier", '') = '' THEN 'Falta el campo Carrier'
  WHEN coalesce("FlightDate", '') = '' THEN 'Falta el campo FlightDate' END"""


def class_sql(column: str) -> str:
    return (
        f'CASE WHEN "{column}" < -15 THEN 0.0 WHEN "{column}" < 0 THEN 1.0 '
        f'WHEN "{column}" < 30 THEN 2.0 WHEN "{column}" >= 30 THEN 3.0 END'
    )


def delay_class(column: str):
    """Rule standing in for a model where a query has to be checked exactly."""
    return F.expr(class_sql(column).replace('"', "`")).cast("double")


def rule_model() -> PipelineModel:
    """The rule as a fitted pipeline, for the scoring jobs."""
    case = class_sql("DepDelay").replace('"', "`")
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({case} AS DOUBLE) AS Prediction FROM __THIS__")])


# --- scans and views -------------------------------------------------------


@query("SELECT * FROM flights", *FLIGHTS)
def scan_flights(spark, sf_dir):
    return V.flights(spark, sf_dir)


@query(
    """SELECT "Origin", "Dest", avg("Distance") AS "Distance", count(*) AS flights
    FROM flights GROUP BY "Origin", "Dest" """,
    *FLIGHTS,
)
def sql_text_view(spark, sf_dir):
    tables.register(V.flights(spark, sf_dir), "on_time")
    return spark.sql(
        "SELECT Origin, Dest, avg(Distance) AS Distance, count(*) AS flights FROM on_time GROUP BY Origin, Dest"
    )


@query(
    """SELECT event_id, event_type, ts AS "Timestamp" FROM events
    WHERE ts >= TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-16'"""
)
def day_requests_scan(spark, sf_dir):
    found = read_requests(spark, f"{sf_dir}/events.parquet", "2024-01-15", fmt="parquet", column="ts")
    return found.select("event_id", "event_type", F.col("ts").alias("Timestamp"))


@query(
    f"""SELECT "Carrier", "Origin", "Dest", "FlightNum", CAST("FlightDate" AS DATE) AS "FlightDate",
      {DEP_TS} AS "CRSDepTime", "Distance", "DepDelay", "ArrDelay"
    FROM flights WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL""",
    *FLIGHTS,
)
def json_feature_file(spark, sf_dir):
    """Features exported as compressed JSON lines and read back by schema."""
    path = f"{new_work_dir(spark)}/features"
    selected = filters.drop_unlabelled(projections.select_features(V.flights(spark, sf_dir)))
    # The file holds the UTC wall clock whatever the session time zone.
    features = derive_features(selected, ntz=True).withColumn("CRSDepTime", F.col("CRSDepTime").cast("string"))
    files.export_json(features, path, compression="gzip")
    wall_clock = StructType(
        [StructField(f.name, f.dataType) for f in FEATURES.fields if f.name not in ("CRSDepTime", "CRSArrTime")]
    ).add("CRSDepTime", "string")
    read = files.read_features(spark, path, wall_clock)
    return read.select(
        "Carrier", "Origin", "Dest", "FlightNum", "FlightDate",
        F.col("CRSDepTime").try_cast("timestamp_ntz").alias("CRSDepTime"),
        "Distance", "DepDelay", "ArrDelay",
    )


@query(
    """SELECT count(*) AS n, 'Dest,Distance,Origin' AS columns
    FROM (SELECT DISTINCT "Origin", "Dest" FROM flights)""",
    *FLIGHTS,
)
def json_inferred_file(spark, sf_dir):
    path = f"{new_work_dir(spark)}/distances"
    files.export_json(aggregates.route_distances(V.flights(spark, sf_dir), None), path, order_by=["Distance"])
    profile = files.describe(files.read_json_inferred(spark, path))
    return profile.select("n", F.array_join("columns", ",").alias("columns"))


@query('SELECT "Origin", "Dest", avg("Distance") AS "Distance" FROM flights GROUP BY 1, 2', *FLIGHTS)
def loaded_distances(spark, sf_dir):
    """Distances from files with two spellings of the field names."""
    path = f"{new_work_dir(spark)}/distances"
    known = aggregates.route_distances(V.flights(spark, sf_dir), None)
    lower = known.filter(F.col("Origin") < F.col("Dest"))
    lower = lower.select([F.col(c).alias(c.lower()) for c in known.columns])
    topics.publish_json(known.filter(F.col("Origin") >= F.col("Dest")), path, fmt="text")
    topics.publish_json(lower, path, fmt="text")
    return distance_source.load_distances(spark, path)


@query('SELECT "UUID", "Origin", "Dest", "Timestamp" FROM requests', *REQUESTS)
def published_table(spark, sf_dir):
    """Requests as a catalog table, laid out by UUID and replaced once."""
    folder = new_work_dir(spark)
    name = f"delaykit_{folder.rsplit('/', 1)[-1]}"
    asked = V.requests(spark, sf_dir)
    tables.publish_table(asked.select("UUID"), name, location=f"{folder}/table")
    kept = asked.select("UUID", "Origin", "Dest", "Timestamp")
    return tables.publish_table(kept, name, bucket_by=(8, ["UUID"]), location=f"{folder}/table")


def _later_responses(answered: DataFrame) -> DataFrame:
    """Second answers to a third of the requests: some as late as what is stored, some later, some earlier."""
    number = F.expr("substring(UUID, 5)").cast("bigint")
    return answered.filter(number % 3 == 0).select(
        "UUID",
        (F.col("Prediction") + 10).alias("Prediction"),
        F.when(number % 9 == 0, F.col("Timestamp"))
        .when(number % 2 == 0, F.col("Timestamp") + F.expr("INTERVAL '1' HOUR"))
        .otherwise(F.col("Timestamp") - F.expr("INTERVAL '1' HOUR"))
        .alias("Timestamp"),
    )


UPSERTED_SQL = """SELECT "UUID",
  CASE WHEN e % 9 = 0 OR e % 6 = 0 THEN "Prediction" + 10 ELSE "Prediction" END AS "Prediction",
  CASE WHEN e % 6 = 0 AND e % 9 <> 0 THEN "Timestamp" + INTERVAL 1 HOUR ELSE "Timestamp" END AS "Timestamp"
FROM (SELECT *, CAST(substr("UUID", 5) AS BIGINT) AS e FROM responses)"""


@query(UPSERTED_SQL, V.ALL_RESPONSES_SQL)
def keyed_upsert(spark, sf_dir):
    """State of a keyed table after two batches, the second of them written twice."""
    root = f"{new_work_dir(spark)}/responses"
    answered = V.all_responses(spark, sf_dir)
    later = _later_responses(answered)
    for batch_id, batch in ((0, answered), (1, later), (1, later)):
        tables.upsert_keyed(batch, root, batch_id)
    return tables.read_keyed(spark, root, ["UUID"], "Timestamp")


@query(UPSERTED_SQL, V.ALL_RESPONSES_SQL)
def merged_state(spark, sf_dir):
    answered = V.all_responses(spark, sf_dir)
    return merge_latest(answered, _later_responses(answered), ["UUID"], "Timestamp")


@query('SELECT "UUID", "Origin", "Dest", "DepDelay" FROM requests', *REQUESTS)
def topic_messages(spark, sf_dir):
    """Requests published as JSON messages and read from the beginning."""
    path = f"{new_work_dir(spark)}/topic"
    topics.publish_json(V.requests(spark, sf_dir).drop("Timestamp"), path, fmt="text")
    read = topics.read_topic(spark, STREAM_REQUEST, fmt="text", path=path)
    return read.select("UUID", "Origin", "Dest", "DepDelay")


# --- projections and scalar functions --------------------------------------


@query(
    """SELECT "FlightNum", "FlightDate", "DayOfWeek", "DayofMonth" AS "DayOfMonth", "Carrier", "Origin",
      "Dest", "Distance", "DepDelay", "ArrDelay", "CRSDepTime", "CRSArrTime" FROM flights""",
    *FLIGHTS,
)
def selected_features(spark, sf_dir):
    return projections.select_features(V.flights(spark, sf_dir))


@query(
    """SELECT "Month" || '-' || "DayofMonth" AS month_day, count(*) AS n FROM flights GROUP BY 1""",
    *FLIGHTS,
)
def month_day_keys(spark, sf_dir):
    keyed = V.flights(spark, sf_dir).groupBy(DF.month_day_key().alias("month_day"))
    return keyed.agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT "CRSDepTime", CASE WHEN "CRSDepTime"[1:2] = '24' THEN '23:59'
      ELSE "CRSDepTime"[1:2] || ':' || "CRSDepTime"[3:4] END AS dep_time FROM flights""",
    *FLIGHTS,
)
def hhmm_times(spark, sf_dir):
    return V.flights(spark, sf_dir).select("CRSDepTime", DF.hhmm_to_time("CRSDepTime").alias("dep_time"))


@query(f'SELECT "FlightDate", "CRSDepTime", {DEP_TS} AS dep_ts FROM flights', *FLIGHTS)
def event_timestamps(spark, sf_dir):
    dep = DF.to_event_ts("FlightDate", "CRSDepTime", ntz=True)
    return V.flights(spark, sf_dir).select("FlightDate", "CRSDepTime", dep.alias("dep_ts"))


@query(f'SELECT "FlightDate", {DEP_TS} AS dep_ts, {ARR_ROLLED} AS arr_ts FROM flights', *FLIGHTS)
def overnight_arrivals(spark, sf_dir):
    dep = DF.to_event_ts("FlightDate", "CRSDepTime", ntz=True)
    arr = DF.to_event_ts("FlightDate", "CRSArrTime", ntz=True)
    timed = V.flights(spark, sf_dir).select("FlightDate", dep.alias("dep_ts"), arr.alias("arr_ts"))
    return timed.withColumn("arr_ts", DF.roll_overnight("dep_ts", "arr_ts"))


@query(
    """SELECT "FlightDate", CAST(dayofyear(CAST("FlightDate" AS DATE)) AS INTEGER) AS "DayOfYear" FROM flights""",
    *FLIGHTS,
)
def day_of_year(spark, sf_dir):
    return V.flights(spark, sf_dir).select("FlightDate", DF.date_parts("FlightDate")["DayOfYear"].alias("DayOfYear"))


@query(
    """SELECT "UUID", CAST(dayofyear(d) AS INTEGER) AS "DayOfYear", CAST(day(d) AS INTEGER) AS "DayOfMonth",
      CAST(isodow(d) AS INTEGER) AS "DayOfWeek", CAST(isodow(d) - 1 AS INTEGER) AS day_of_week_zero
    FROM (SELECT "UUID", CAST("FlightDate" AS DATE) AS d FROM requests)""",
    *REQUESTS,
)
def request_date_parts(spark, sf_dir):
    dated = request_ops.with_date_parts(V.requests(spark, sf_dir))
    zero = DF.date_parts("FlightDate", "zero")["DayOfWeek"]
    return dated.select("UUID", "DayOfYear", "DayOfMonth", "DayOfWeek", zero.alias("day_of_week_zero"))


@query(
    """SELECT CAST("FlightDate" AS DATE) AS "FlightDate", "DayOfWeek", "DepDelay",
      TRY_CAST("Carrier" AS INTEGER) AS "CarrierNumber", CAST("FlightNum" AS INTEGER) AS "FlightNumber"
    FROM flights""",
    *FLIGHTS,
)
def conformed_types(spark, sf_dir):
    """Text columns cast to a schema; what cannot be cast is null."""
    text = V.flights(spark, sf_dir).select(
        "FlightDate",
        F.col("DayOfWeek").cast("string").alias("DayOfWeek"),
        F.col("DepDelay").cast("string").alias("DepDelay"),
        F.col("Carrier").alias("CarrierNumber"),
        F.col("FlightNum").alias("FlightNumber"),
    )
    schema = "FlightDate date, DayOfWeek int, DepDelay double, CarrierNumber int, FlightNumber int"
    return projections.conform(text, StructType.fromDDL(schema))


@query(
    """SELECT "Origin" || '-' || "Dest" AS "Route", count(*) AS n FROM requests GROUP BY 1""", *REQUESTS
)
def routes(spark, sf_dir):
    routed = projections.with_route(V.requests(spark, sf_dir))
    return routed.groupBy("Route").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parsed_messages(spark, sf_dir):
    """Event properties as message bytes; the id is written into the message, as a UUID is."""
    events = V.table(spark, sf_dir, "events")
    message = F.expr("""concat('{"event_id": ', event_id, ', ', substring(props, 2))""")
    messages = events.select(message.cast("binary").alias("value"))
    return request_ops.parse_requests(messages, StructType.fromDDL("event_id bigint, k int"))


@query(
    """SELECT '{"UUID":"' || "UUID" || '"' || coalesce(',"Origin":"' || "Origin" || '"', '')
      || coalesce(',"DepDelay":' || "DepDelay", '') || coalesce(',"FlightNum":"' || "FlightNum" || '"', '')
      || '}' AS value FROM requests""",
    *REQUESTS,
)
def encoded_messages(spark, sf_dir):
    return request_ops.encode_rows(V.requests(spark, sf_dir), ["UUID", "Origin", "DepDelay", "FlightNum"])


STORAGE_SQL = f"""SELECT "UUID" AS uuid, "Origin" AS origin, "Dest" AS dest, "Carrier" AS carrier,
  "Origin" || '-' || "Dest" AS route, CAST("FlightDate" AS DATE) AS flight_date,
  CAST(isodow(CAST("FlightDate" AS DATE)) AS INTEGER) AS day_of_week,
  CAST(dayofyear(CAST("FlightDate" AS DATE)) AS INTEGER) AS day_of_year,
  CAST(day(CAST("FlightDate" AS DATE)) AS INTEGER) AS day_of_month,
  coalesce("DepDelay", 0.0) AS dep_delay, coalesce(d."Distance", 0.0) AS distance,
  CAST(CASE WHEN coalesce("DepDelay", 0.0) < -15 THEN 0.0 WHEN coalesce("DepDelay", 0.0) < 0 THEN 1.0
       WHEN coalesce("DepDelay", 0.0) < 30 THEN 2.0 ELSE 3.0 END AS DOUBLE) AS prediction,
  "Timestamp" AS "timestamp"
FROM requests LEFT JOIN distances d USING ("Origin", "Dest") WHERE {VALID}"""


_STORED: dict[tuple[str, str, str], str] = {}


def _once(spark, sf_dir, name: str, make: Callable[[str], None]) -> str:
    """Folder that ``make`` fills, once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        folder = new_work_dir(spark)
        make(folder)
        _STORED[key] = folder
    return _STORED[key]


def _distances(spark, sf_dir) -> DataFrame:
    """The keyed table of the distances job, without one origin, so that defaults are used."""
    known = V.flights(spark, sf_dir).filter(F.col("Origin") != "NATION_3")
    folder = _once(spark, sf_dir, "distances", lambda f: distance_job(spark, known, f"{f}/json", f"{f}/table"))
    return tables.read_keyed(spark, f"{folder}/table", ["Origin", "Dest"])


def _labelled(spark, sf_dir) -> DataFrame:
    """Labelled features, stored because indexes, vectors and the forest read them."""
    make = lambda f: ml.trainable(extract_features(V.flights(spark, sf_dir))).write.parquet(f"{f}/labelled")
    return spark.read.parquet(f"{_once(spark, sf_dir, 'labelled', make)}/labelled")


def _prepared(spark, sf_dir) -> DataFrame:
    scorable, _ = prepare_requests(V.requests(spark, sf_dir), _distances(spark, sf_dir))
    return scorable


@query(STORAGE_SQL, *ROUTED)
def storage_names(spark, sf_dir):
    return projections.to_storage(score(rule_model(), _prepared(spark, sf_dir)))


@query(
    f"""SELECT uuid AS "UUID", origin AS "Origin", dest AS "Dest", carrier AS "Carrier", route AS "Route",
      flight_date AS "FlightDate", day_of_week AS "DayOfWeek", day_of_year AS "DayOfYear",
      day_of_month AS "DayOfMonth", dep_delay AS "DepDelay", distance AS "Distance",
      prediction AS "Prediction", "timestamp" AS "Timestamp" FROM ({STORAGE_SQL})""",
    *ROUTED,
)
def api_names(spark, sf_dir):
    return projections.to_api(projections.to_storage(score(rule_model(), _prepared(spark, sf_dir))))


@query(
    f"""SELECT "Carrier", "Origin", "Dest", CAST({class_sql('ArrDelay')} AS DOUBLE) AS "ArrDelayBucket",
      count(*) AS n FROM flights WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL GROUP BY ALL""",
    *FLIGHTS,
)
def stripped_columns(spark, sf_dir):
    """Vectors and indexes are dropped again and leave the rows as they were."""
    labelled = _labelled(spark, sf_dir)
    vectors = ml.assembler().transform(ml.index_categories(labelled).transform(labelled))
    kept = projections.strip_ml_columns(vectors)
    extra = [c for c in kept.columns if c not in labelled.columns]
    return kept.groupBy("Carrier", "Origin", "Dest", "ArrDelayBucket", *extra).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT "UUID",
      CASE "Prediction" WHEN 0 THEN 'Early (15+ Minutes Early)' WHEN 1 THEN 'Slightly Early (0-15 Minute Early)'
        WHEN 2 THEN 'Slightly Late (0-30 Minute Delay)' WHEN 3 THEN 'Very Late (30+ Minutes Late)'
        ELSE 'Unknown' END AS label_splits,
      CASE "Prediction" WHEN 0 THEN 'Early / No Delay' WHEN 1 THEN 'On Time'
        WHEN 2 THEN 'Slightly Late (0-30 Minute Delay)' WHEN 3 THEN 'Very Late (+30 Minute Delay)'
        ELSE 'Unknown' END AS label_live,
      CASE "Prediction" WHEN 0 THEN 'EARLY' WHEN 1 THEN 'ON TIME' WHEN 2 THEN 'SLIGHT DELAY'
        WHEN 3 THEN 'VERY LATE' ELSE 'UNKNOWN' END AS label_board,
      CASE "Prediction" WHEN 0 THEN 'On Time (0-15 Minute Delay)' WHEN 1 THEN 'Slightly Late (15-60 Minute Delay)'
        WHEN 2 THEN 'Very Late (60+ Minute Delay)' ELSE 'Unknown' END AS label_batch
    FROM responses""",
    V.ALL_RESPONSES_SQL,
)
def delay_labels(spark, sf_dir):
    labels = [DF.delay_label("Prediction", s).alias(f"label_{s}") for s in DF.LABEL_SCHEMES]
    return V.all_responses(spark, sf_dir).select("UUID", *labels)


@query(
    """SELECT "UUID", CASE "Prediction" WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 3 THEN 'late' ELSE 'warn' END
      AS severity FROM responses""",
    V.ALL_RESPONSES_SQL,
)
def severities(spark, sf_dir):
    return V.all_responses(spark, sf_dir).select("UUID", DF.severity("Prediction").alias("severity"))


@query(
    """SELECT "UUID", coalesce("DepDelay", 0.0) AS "DepDelay", coalesce("FlightNum", '0') AS "FlightNum"
    FROM requests""",
    *REQUESTS,
)
def defaulted_requests(spark, sf_dir):
    return request_ops.default_request(V.requests(spark, sf_dir)).select("UUID", "DepDelay", "FlightNum")


@query(
    """SELECT count(*) AS n, count(*) AS ids, count(*) FILTER (event_id % 2 = 0) AS kept_ids FROM events"""
)
def stamped_requests(spark, sf_dir):
    """Every request gets a distinct id; half of them bring their own."""
    asked = V.requests(spark, sf_dir)
    number = F.expr("substring(UUID, 5)").cast("bigint")
    own = asked.withColumn("own_id", F.when(number % 2 == 0, F.col("UUID")))
    stamped = request_ops.stamp_requests(own, "own_id")
    return stamped.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("UUID").alias("ids"),
        F.count_if(F.col("UUID") == F.col("own_id")).alias("kept_ids"),
    )


@query(
    """SELECT "UUID", coalesce(CASE WHEN "FlightNum" <> '0' THEN "FlightNum" END, nullif("Carrier", ''))
      AS first_value FROM requests""",
    *REQUESTS,
)
def first_present_values(spark, sf_dir):
    return V.requests(spark, sf_dir).select("UUID", DF.first_present(["FlightNum", "Carrier"]).alias("first_value"))


@query(
    f"""SELECT "FlightNum", CAST("FlightDate" AS DATE) AS "FlightDate", "DayOfWeek",
      "DayofMonth" AS "DayOfMonth", CAST(dayofyear(CAST("FlightDate" AS DATE)) AS INTEGER) AS "DayOfYear",
      "Carrier", "Origin", "Dest", "Distance", "DepDelay", "ArrDelay",
      {DEP_TS} AS "CRSDepTime", {ARR_ROLLED} AS "CRSArrTime"
    FROM flights WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL""",
    *FLIGHTS,
)
def feature_table(spark, sf_dir):
    """The whole feature job: select, filter, derive, sort."""
    selected = filters.drop_unlabelled(projections.select_features(V.flights(spark, sf_dir)))
    derived = derive_features(selected, ntz=True)
    return ordering.sort_features(derived.withColumn("FlightDate", F.col("FlightDate").try_cast("date")))


# --- filters ----------------------------------------------------------------


@query(
    """SELECT "TailNum", "FlightDate", "DepDelay", "ArrDelay" FROM flights
    WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL""",
    *FLIGHTS,
)
def labelled_flights(spark, sf_dir):
    kept = filters.drop_unlabelled(V.flights(spark, sf_dir))
    return kept.select("TailNum", "FlightDate", "DepDelay", "ArrDelay")


@query(
    """SELECT "UUID", "Timestamp" FROM requests
    WHERE "Timestamp" >= TIMESTAMP '2024-01-10' AND "Timestamp" <= TIMESTAMP '2024-01-11'""",
    *REQUESTS,
)
def requests_of_day(spark, sf_dir):
    return filters.for_day(V.requests(spark, sf_dir), "2024-01-10").select("UUID", "Timestamp")


@query(
    """SELECT "UUID", "Timestamp" FROM requests
    WHERE "Timestamp" >= TIMESTAMP '2024-01-10' AND "Timestamp" < TIMESTAMP '2024-01-11'""",
    *REQUESTS,
)
def requests_of_day_half_open(spark, sf_dir):
    return filters.for_day(V.requests(spark, sf_dir), "2024-01-10", inclusive=False).select("UUID", "Timestamp")


@query(f'SELECT * FROM requests WHERE {VALID}', *REQUESTS)
def valid_requests(spark, sf_dir):
    return filters.split_valid(V.requests(spark, sf_dir))[0]


@query(f'SELECT *, {ERROR} AS error FROM requests WHERE NOT ({VALID})', *REQUESTS)
def rejected_requests(spark, sf_dir):
    return filters.split_valid(V.requests(spark, sf_dir))[1]


@query("""SELECT * FROM flights WHERE "Carrier" = 'AF' AND "Origin" = 'NATION_7'""", *FLIGHTS)
def flight_search(spark, sf_dir):
    criteria = {"Carrier": "AF", "Origin": "NATION_7", "Dest": "", "TailNum": None}
    return filters.search(V.flights(spark, sf_dir), criteria)


# --- lookups ----------------------------------------------------------------


@query(
    f"""SELECT "UUID", "Origin", "Dest", coalesce(d."Distance", 0.0) AS "Distance"
    FROM requests LEFT JOIN distances d USING ("Origin", "Dest")""",
    *ROUTED,
)
def request_distances(spark, sf_dir):
    found = lookups.with_distance(V.requests(spark, sf_dir), _distances(spark, sf_dir))
    return found.select("UUID", "Origin", "Dest", "Distance")


@query(
    f"""SELECT "UUID", "Origin", "Dest", "Carrier", "FlightDate", coalesce("DepDelay", 0.0) AS "DepDelay",
      coalesce("FlightNum", '0') AS "FlightNum", "Timestamp", coalesce(d."Distance", 0.0) AS "Distance",
      CAST(dayofyear(CAST("FlightDate" AS DATE)) AS INTEGER) AS "DayOfYear",
      CAST(day(CAST("FlightDate" AS DATE)) AS INTEGER) AS "DayOfMonth",
      CAST(isodow(CAST("FlightDate" AS DATE)) AS INTEGER) AS "DayOfWeek"
    FROM requests LEFT JOIN distances d USING ("Origin", "Dest") WHERE {VALID}""",
    *ROUTED,
)
def prepared_requests(spark, sf_dir):
    return _prepared(spark, sf_dir)


@query(
    """SELECT q."UUID", CASE WHEN r."UUID" IS NULL THEN 'WAIT' ELSE 'OK' END AS status, r."Prediction"
    FROM requests q LEFT JOIN responses r USING ("UUID")""",
    *ANSWERS,
)
def request_status(spark, sf_dir):
    return lookups.request_status(V.requests(spark, sf_dir), V.responses(spark, sf_dir))


AWAIT_SQL = """SELECT q."UUID", q."Timestamp",
  CASE WHEN r."UUID" IS NULL THEN 'TIMEOUT' ELSE 'ANSWERED' END AS status,
  r."Timestamp" AS answered_at, r."Prediction"
FROM requests q LEFT JOIN answers r ON q."UUID" = r."UUID"
  AND r."Timestamp" BETWEEN q."Timestamp" AND q."Timestamp" + INTERVAL 120 SECOND
QUALIFY row_number() OVER (PARTITION BY q."UUID" ORDER BY r."Timestamp", r."Prediction") = 1"""
REPEATED = (V.REQUESTS_SQL, V.RESPONSES_SQL, V.ANSWERS_SQL)


@query(AWAIT_SQL, *REPEATED)
def awaited_responses(spark, sf_dir):
    return lookups.await_responses(V.requests(spark, sf_dir), V.answers(spark, sf_dir))


@query(
    """SELECT f."Carrier", f."TailNum", count(*) OVER (PARTITION BY f."Carrier") AS "FleetCount",
      a."CarrierCode", a."Name"
    FROM (SELECT DISTINCT "Carrier", "TailNum" FROM flights) f
    LEFT JOIN airlines a ON f."Carrier" = a."CarrierCode" """,
    V.FLIGHTS_SQL,
    V.AIRLINES_SQL,
)
def carrier_profiles(spark, sf_dir):
    fleets = aggregates.airplanes_per_carrier(V.flights(spark, sf_dir))
    return lookups.carrier_profile(V.airlines(spark, sf_dir), fleets)


@query(
    """SELECT q."UUID", q."Origin", q."Dest", r."Timestamp" AS answered_at, r."Prediction"
    FROM requests q JOIN responses r USING ("UUID")""",
    *ANSWERS,
)
def matched_responses(spark, sf_dir):
    matched = lookups.match_responses(V.requests(spark, sf_dir), V.responses(spark, sf_dir))
    return matched.select("UUID", "Origin", "Dest", "answered_at", "Prediction")


# --- aggregations -----------------------------------------------------------


@query('SELECT "Origin", "Dest", avg("Distance") AS "Distance" FROM flights GROUP BY 1, 2', *FLIGHTS)
def route_distances(spark, sf_dir):
    return aggregates.route_distances(V.flights(spark, sf_dir))


@query('SELECT "Origin", "Dest", avg("Distance") AS "Distance" FROM flights GROUP BY 1, 2', *FLIGHTS)
def route_distances_descending(spark, sf_dir):
    return aggregates.route_distances(V.flights(spark, sf_dir), "desc")


@query("SELECT count(*) AS n FROM flights", *FLIGHTS)
def flight_count(spark, sf_dir):
    return aggregates.row_count(V.flights(spark, sf_dir))


@query(
    """SELECT * FROM (
      SELECT 'DepDelay' AS column_name, count(*) FILTER ("DepDelay" IS NULL) AS nulls FROM flights
      UNION ALL SELECT 'ArrDelay', count(*) FILTER ("ArrDelay" IS NULL) FROM flights)
    WHERE nulls > 0""",
    *FLIGHTS,
)
def null_profile(spark, sf_dir):
    return aggregates.null_profile(V.flights(spark, sf_dir))


@query(
    f"""SELECT CAST({class_sql('DepDelay')} AS DOUBLE) AS "Prediction", count(*) AS n FROM flights GROUP BY 1""",
    *FLIGHTS,
)
def prediction_distribution(spark, sf_dir):
    ruled = V.flights(spark, sf_dir).withColumn("Prediction", delay_class("DepDelay"))
    return aggregates.prediction_distribution(ruled)


@query(
    f"""SELECT avg(CASE WHEN {class_sql('DepDelay')} = {class_sql('ArrDelay')} THEN 1.0 ELSE 0.0 END) AS accuracy
    FROM flights WHERE "DepDelay" IS NOT NULL AND "ArrDelay" IS NOT NULL""",
    *FLIGHTS,
)
def rule_accuracy(spark, sf_dir):
    ruled = ml.delay_bucket(V.flights(spark, sf_dir)).withColumn("Prediction", delay_class("DepDelay"))
    return aggregates.accuracy(ruled)


@query('SELECT "Year", "Month", count(*) AS total_flights FROM flights GROUP BY 1, 2', *FLIGHTS)
def flights_by_month(spark, sf_dir):
    return aggregates.flights_by_month(V.flights(spark, sf_dir))


@query('SELECT "TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest" FROM flights', *FLIGHTS)
def flights_per_airplane(spark, sf_dir):
    return aggregates.flights_per_airplane(V.flights(spark, sf_dir))


@query('SELECT "TailNum", count(*) AS "FlightCount" FROM flights GROUP BY 1', *FLIGHTS)
def airplane_totals(spark, sf_dir):
    return aggregates.airplane_totals(V.flights(spark, sf_dir))


@query('SELECT DISTINCT "Carrier", "TailNum" FROM flights', *FLIGHTS)
def airplanes_per_carrier(spark, sf_dir):
    return aggregates.airplanes_per_carrier(V.flights(spark, sf_dir))


@query('SELECT "Carrier", count(DISTINCT "TailNum") AS "FleetCount" FROM flights GROUP BY 1', *FLIGHTS)
def fleet_totals(spark, sf_dir):
    return aggregates.fleet_totals(aggregates.airplanes_per_carrier(V.flights(spark, sf_dir)))


@query('SELECT "Manufacturer", count(*) AS "Total" FROM airplanes GROUP BY 1', V.AIRPLANES_SQL)
def manufacturer_totals(spark, sf_dir):
    return aggregates.manufacturer_totals(V.airplanes(spark, sf_dir))


@query(
    """SELECT CAST(bin AS INTEGER) AS bin, count(*) AS value,
      CASE bin WHEN 0 THEN '[-inf, -15)' WHEN 1 THEN '[-15, 0)' WHEN 2 THEN '[0, 15)' WHEN 3 THEN '[15, 30)'
        ELSE '[30, inf)' END AS label
    FROM (SELECT CASE WHEN "ArrDelay" < -15 THEN 0 WHEN "ArrDelay" < 0 THEN 1 WHEN "ArrDelay" < 15 THEN 2
      WHEN "ArrDelay" < 30 THEN 3 ELSE 4 END AS bin FROM flights WHERE "ArrDelay" IS NOT NULL)
    GROUP BY bin""",
    *FLIGHTS,
)
def delay_histogram(spark, sf_dir):
    return aggregates.delay_histogram(V.flights(spark, sf_dir), "ArrDelay", [-15, 0, 15, 30])


@query('SELECT DISTINCT "Origin", "Dest", "Carrier" FROM flights', *FLIGHTS)
def distinct_routes(spark, sf_dir):
    ends = V.flights(spark, sf_dir).select("Origin", "Dest", "Carrier")
    return aggregates.distinct_rows(ends, order=["Origin", "Dest", "Carrier"])


# --- sorts, pages, samples --------------------------------------------------


@query(
    """SELECT * FROM flights WHERE "Origin" = 'NATION_1' AND "Dest" = 'NATION_13'
      AND "FlightDate" = '1996-07-28'""",
    *FLIGHTS,
)
def listed_flights(spark, sf_dir):
    order = ("CRSDepTime", "CRSArrTime")
    return ordering.list_flights(V.flights(spark, sf_dir), "NATION_1", "NATION_13", "1996-07-28", order)


@query(
    """SELECT count(*) AS flight_count FROM flights WHERE "Origin" = 'NATION_1' AND "Dest" = 'NATION_13'
      AND "FlightDate" = '1996-07-28'""",
    *FLIGHTS,
)
def listed_flight_count(spark, sf_dir):
    found = ordering.flights_of(V.flights(spark, sf_dir), "NATION_1", "NATION_13", "1996-07-28")
    return aggregates.row_count(found).withColumnRenamed("n", "flight_count")


@query(
    """SELECT uuid, prediction, "timestamp" FROM stored_responses ORDER BY "timestamp" DESC, uuid LIMIT 30""",
    *STORED,
)
def prediction_history(spark, sf_dir):
    newest = ordering.prediction_history(V.stored_responses(spark, sf_dir))
    return newest.select("uuid", "prediction", "timestamp")


@query('SELECT * FROM requests ORDER BY "Timestamp", "UUID" LIMIT 15 OFFSET 30', *REQUESTS)
def request_page(spark, sf_dir):
    return ordering.page(V.requests(spark, sf_dir), 30, 45, ["Timestamp", "UUID"])


@query(
    """SELECT * FROM flights WHERE "Carrier" = 'RO' AND "Dest" = 'NATION_4'
    ORDER BY "FlightDate", "FlightNum", "Year", "Month", "DayofMonth", "DayOfWeek", "Carrier", "TailNum",
      "Origin", "Dest", "Distance", "DepDelay" NULLS FIRST, "ArrDelay" NULLS FIRST, "CRSDepTime", "CRSArrTime"
    LIMIT 15""",
    *FLIGHTS,
)
def flight_search_page(spark, sf_dir):
    return ordering.search_flights(V.flights(spark, sf_dir), {"Carrier": "RO", "Dest": "NATION_4"})


@query(
    """SELECT * FROM airplanes WHERE "Model" = 'ECONOMY'
    ORDER BY "Owner", "Manufacturer", "Model", "EngineManufacturer", "EngineModel", "TailNum" LIMIT 5""",
    V.AIRPLANES_SQL,
)
def airplane_search_page(spark, sf_dir):
    return ordering.search_airplanes(V.airplanes(spark, sf_dir), {"Model": "ECONOMY", "Owner": ""})


@query(
    """SELECT * FROM flights WHERE "Carrier" = 'AF' AND "FlightNum" = '100'
    ORDER BY "FlightNum", "FlightDate", "Year", "Month", "DayofMonth", "DayOfWeek", "Carrier", "TailNum",
      "Origin", "Dest", "Distance", "DepDelay" NULLS FIRST, "ArrDelay" NULLS FIRST, "CRSDepTime", "CRSArrTime"
    LIMIT 1""",
    *FLIGHTS,
)
def first_match(spark, sf_dir):
    return ordering.find_one(V.flights(spark, sf_dir), {"Carrier": "AF", "FlightNum": "100"})


@query()
def sampled_flights(spark, sf_dir):
    return ordering.sample_rows(V.flights(spark, sf_dir), 0.1, 27)


@query()
def hash_sampled_requests(spark, sf_dir):
    return ordering.sample_rows(V.requests(spark, sf_dir), 0.1, 27, key="UUID")


SAMPLED_SQL = """SELECT count(*) AS n, CAST(0 AS BIGINT) AS strangers, CAST(0 AS BIGINT) AS repeats,
  true AS within_bounds FROM events"""


def _sample_facts(asked: DataFrame, sample: DataFrame) -> DataFrame:
    taken = sample.groupBy("UUID").agg(F.count(F.lit(1)).alias("times"))
    both = asked.select("UUID", F.lit(1).alias("asked")).join(taken, "UUID", "full")
    known, share = F.count("asked"), F.count("times")
    # Six standard deviations around a tenth.
    off = F.abs(share - 0.1 * known) <= 6 * F.sqrt(0.09 * known)
    return both.agg(
        known.alias("n"),
        F.count_if(F.col("asked").isNull()).alias("strangers"),
        F.count_if(F.col("times") > 1).alias("repeats"),
        off.alias("within_bounds"),
    )


@query(SAMPLED_SQL)
def sample_facts(spark, sf_dir):
    """A sample by position has rows of the table only, none of them twice, and about the share asked for."""
    asked = V.requests(spark, sf_dir)
    return _sample_facts(asked, ordering.sample_rows(asked, 0.1, 27))


@query(SAMPLED_SQL)
def hash_sample_facts(spark, sf_dir):
    return _sample_facts(V.requests(spark, sf_dir), hash_sampled_requests(spark, sf_dir))


@query('SELECT * FROM requests ORDER BY "UUID" LIMIT 20', *REQUESTS)
def request_preview(spark, sf_dir):
    return ordering.preview(V.requests(spark, sf_dir), 20, ["UUID"])


# --- model preparation and models -------------------------------------------

LABELLED_SQL = f"""labelled AS (
  SELECT *, "Origin" || '-' || "Dest" AS "Route", CAST({class_sql('ArrDelay')} AS DOUBLE) AS "ArrDelayBucket"
  FROM flights WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL
)"""
INDEXES_SQL = """indexes AS (
  SELECT column_name, value,
         CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx
  FROM (
    SELECT 'Carrier' AS column_name, "Carrier" AS value, count(*) AS n FROM labelled GROUP BY 2
    UNION ALL SELECT 'Origin', "Origin", count(*) FROM labelled GROUP BY 2
    UNION ALL SELECT 'Dest', "Dest", count(*) FROM labelled GROUP BY 2
    UNION ALL SELECT 'Route', "Route", count(*) FROM labelled GROUP BY 2
  )
)"""


@query(
    f"""SELECT "Carrier", "ArrDelay", CAST({class_sql('ArrDelay')} AS DOUBLE) AS "ArrDelayBucket" FROM flights""",
    *FLIGHTS,
)
def delay_buckets(spark, sf_dir):
    return ml.delay_bucket(V.flights(spark, sf_dir)).select("Carrier", "ArrDelay", "ArrDelayBucket")


@query("SELECT column_name, value, idx FROM indexes", V.FLIGHTS_SQL, LABELLED_SQL, INDEXES_SQL)
def category_indexes(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    indexed = ml.index_categories(labelled).transform(labelled)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col(f"{c}_index").alias("idx"))
            for c in ["Carrier", "Origin", "Dest", "Route"]
        ]
    )
    # One row per route holds all four values, so few rows are exploded.
    return indexed.dropDuplicates(["Carrier", "Route"]).select(F.inline(pairs)).distinct()


@query(
    """SELECT "DepDelay" AS f0, "Distance" AS f1, CAST("DayofMonth" AS DOUBLE) AS f2,
      CAST("DayOfWeek" AS DOUBLE) AS f3, CAST(dayofyear(CAST("FlightDate" AS DATE)) AS DOUBLE) AS f4,
      c.idx AS f5, o.idx AS f6, d.idx AS f7, r.idx AS f8, "ArrDelayBucket" AS label
    FROM labelled
    JOIN indexes c ON c.column_name = 'Carrier' AND c.value = "Carrier"
    JOIN indexes o ON o.column_name = 'Origin' AND o.value = "Origin"
    JOIN indexes d ON d.column_name = 'Dest' AND d.value = "Dest"
    JOIN indexes r ON r.column_name = 'Route' AND r.value = "Route" """,
    V.FLIGHTS_SQL,
    LABELLED_SQL,
    INDEXES_SQL,
)
def feature_vectors(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    vectors = ml.assembler().transform(ml.index_categories(labelled).transform(labelled))
    values = vectors.select(vector_to_array("Features_vec").alias("v"), "ArrDelayBucket")
    return values.select(*[F.col("v")[i].alias(f"f{i}") for i in range(9)], F.col("ArrDelayBucket").alias("label"))


_FORESTS: dict[tuple[str, str], tuple[str, dict[str, DataFrame]]] = {}


def _forest(spark, sf_dir) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Forest trained on the stored labelled features of ``sf_dir``, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FORESTS:
        folder = new_work_dir(spark)
        _, reports = train_job(_labelled(spark, sf_dir), f"{folder}/model")
        _FORESTS[key] = (f"{folder}/model", reports)
    path, reports = _FORESTS[key]
    return models.load_model(path), reports


@query()
def forest_accuracy(spark, sf_dir):
    return _forest(spark, sf_dir)[1]["accuracy"]


@query()
def forest_distribution(spark, sf_dir):
    return _forest(spark, sf_dir)[1]["distribution"]


@query()
def forest_predictions(spark, sf_dir):
    model, _ = _forest(spark, sf_dir)
    return score(model, _prepared(spark, sf_dir)).select("UUID", "Route", "DepDelay", "Prediction")


@query(
    f"""SELECT "UUID", "Origin" || '-' || "Dest" AS "Route", coalesce("DepDelay", 0.0) AS "DepDelay",
      true AS known_class FROM requests WHERE {VALID}""",
    *REQUESTS,
)
def forest_classes(spark, sf_dir):
    """Every valid request gets one of the four classes."""
    known = F.coalesce(F.col("Prediction").isin(0.0, 1.0, 2.0, 3.0), F.lit(False))
    return forest_predictions(spark, sf_dir).select("UUID", "Route", "DepDelay", known.alias("known_class"))


@query(
    """SELECT count(*) AS labelled, true AS beats_largest_class FROM flights
    WHERE "ArrDelay" IS NOT NULL AND "DepDelay" IS NOT NULL""",
    *FLIGHTS,
)
def forest_report(spark, sf_dir):
    """Training and held-out rows are all labelled rows; the forest does better than the most frequent class."""
    accuracy = forest_accuracy(spark, sf_dir).agg(F.sum("n").alias("labelled"), F.min("accuracy").alias("least"))
    classes = _labelled(spark, sf_dir).groupBy("ArrDelayBucket").agg(F.count(F.lit(1)).alias("n"))
    largest = classes.agg((F.max("n") / F.sum("n")).alias("share")).withColumn("one", F.lit(1))
    both = accuracy.withColumn("one", F.lit(1)).join(largest, "one")
    return both.select("labelled", (F.col("least") > F.col("share")).alias("beats_largest_class"))


@query(f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS otherwise FROM requests WHERE {VALID}", *REQUESTS)
def saved_model(spark, sf_dir):
    """Requests scored by the model and by what is loaded after saving it once more."""
    model, _ = _forest(spark, sf_dir)
    path = f"{new_work_dir(spark)}/model"
    models.save_model(model, path)
    asked = _prepared(spark, sf_dir)
    first = score(model, asked).select("UUID", "Prediction")
    second = score(models.load_model(path), asked).select("UUID", F.col("Prediction").alias("again"))
    same = F.col("Prediction").eqNullSafe(F.col("again"))
    return first.join(second, "UUID").agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("otherwise"))


@query(
    f"""SELECT "Carrier", "Origin", "Dest", "Origin" || '-' || "Dest" AS "Route",
      CAST("FlightDate" AS DATE) AS "FlightDate", coalesce("DepDelay", 0.0) AS "DepDelay",
      coalesce(d."Distance", 0.0) AS "Distance",
      CAST(CASE WHEN coalesce("DepDelay", 0.0) < -15 THEN 0.0 WHEN coalesce("DepDelay", 0.0) < 0 THEN 1.0
        WHEN coalesce("DepDelay", 0.0) < 30 THEN 2.0 ELSE 3.0 END AS DOUBLE) AS "Prediction"
    FROM requests LEFT JOIN distances d USING ("Origin", "Dest")
    WHERE {VALID} AND "Timestamp" >= TIMESTAMP '2024-01-12' AND "Timestamp" <= TIMESTAMP '2024-01-13'""",
    *ROUTED,
)
def daily_scoring(spark, sf_dir):
    """The three daily steps for one day, with the rule as the model."""
    root, day = new_work_dir(spark), "2024-01-12"
    _prepared(spark, sf_dir).write.parquet(f"{root}/requests")
    daily.fetch_day(spark, day, root, f"{root}/requests", fmt="parquet")
    daily.score_day(spark, day, root, rule_model())
    daily.load_day(spark, day, root, f"{root}/results", fmt="parquet")
    loaded = spark.read.parquet(f"{root}/results")
    return loaded.select("Carrier", "Origin", "Dest", "Route", "FlightDate", "DepDelay", "Distance", "Prediction")


@query(
    f"""SELECT "Origin", "Dest", "FlightNum", {ERROR} AS error
    FROM (SELECT * REPLACE (coalesce("FlightNum", '0') AS "FlightNum") FROM requests) WHERE NOT ({VALID})
      AND "Timestamp" >= TIMESTAMP '2024-01-12' AND "Timestamp" <= TIMESTAMP '2024-01-13'""",
    *REQUESTS,
)
def daily_rejects(spark, sf_dir):
    """Requests of a day that cannot be scored, with the reason."""
    root, day = new_work_dir(spark), "2024-01-12"
    asked = request_ops.with_date_parts(lookups.with_distance(V.requests(spark, sf_dir), _distances(spark, sf_dir)))
    asked.write.parquet(f"{root}/requests")
    daily.fetch_day(spark, day, root, f"{root}/requests", fmt="parquet")
    daily.score_day(spark, day, root, rule_model())
    kept = StructType([*BATCH_REQUEST.fields]).add("error", "string")
    rejected = files.read_daily(spark, f"{root}/{daily.REJECTS}", day, kept)
    return rejected.select("Origin", "Dest", "FlightNum", "error")


# --- streams ----------------------------------------------------------------


def _messages(spark, sf_dir, folder: str) -> DataFrame:
    """Stream over all requests, valid or not, as JSON messages."""
    asked = V.requests(spark, sf_dir).withColumn("Timestamp", F.col("Timestamp").cast("string"))
    enriched = request_ops.with_date_parts(lookups.with_distance(asked, _distances(spark, sf_dir)))
    topics.publish_json(enriched, f"{folder}/requests", fmt="text")
    return topics.read_request_stream(spark, fmt="text", path=f"{folder}/requests")


@query(
    """SELECT "UUID", "Origin", "Dest", "Carrier", "FlightDate", "DepDelay", "FlightNum", "Timestamp"
    FROM requests""",
    *REQUESTS,
)
def stream_requests(spark, sf_dir):
    folder = new_work_dir(spark)
    typed = scoring.request_stream(_messages(spark, sf_dir, folder))
    (
        typed.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/typed")
        .awaitTermination()
    )
    read = spark.read.parquet(f"{folder}/typed")
    return read.select(
        "UUID", "Origin", "Dest", "Carrier", "FlightDate", "DepDelay", "FlightNum",
        F.col("Timestamp").try_cast("timestamp_ntz").alias("Timestamp"),
    )


def _run_scoring(requests: DataFrame, folder: str, checkpoint: str) -> None:
    model = rule_model()
    scoring.start_scoring(
        requests,
        lambda: model,
        scoring.keyed_table_sink(f"{folder}/table"),
        scoring.response_topic_sink(f"{folder}/topic", fmt="json"),
        f"{folder}/{checkpoint}",
        scoring.reject_sink(f"{folder}/rejected"),
        {"availableNow": True},
    ).awaitTermination()


def _scored_stream(spark, sf_dir) -> str:
    folder = new_work_dir(spark)
    _run_scoring(scoring.request_stream(_messages(spark, sf_dir, folder)), folder, "checkpoint")
    return folder


@query(STORAGE_SQL.replace(""",
  "Timestamp" AS "timestamp\"""", ""), *ROUTED)
def stream_scoring(spark, sf_dir):
    """State of the response table after the stream."""
    folder = _scored_stream(spark, sf_dir)
    return tables.read_keyed(spark, f"{folder}/table", ["uuid"], "timestamp").drop("timestamp")


STATE_SQL = STORAGE_SQL.replace(""",
  "Timestamp" AS "timestamp\"""", "")


@query(STATE_SQL, *ROUTED)
def stream_restart(spark, sf_dir):
    """State after a third of the messages, a second third after a restart, and the last by another stream.

    The other stream has its own messages and checkpoint but writes to the same table, so its batches must not
    take the place of the first stream's.
    """
    folder = new_work_dir(spark)
    asked = V.requests(spark, sf_dir).withColumn("Timestamp", F.col("Timestamp").cast("string"))
    enriched = request_ops.with_date_parts(lookups.with_distance(asked, _distances(spark, sf_dir)))
    third = F.expr("substring(UUID, 5)").cast("bigint") % 3
    for part, name in ((0, "first"), (1, "first"), (2, "second")):
        topics.publish_json(enriched.filter(third == part), f"{folder}/{name}_requests", fmt="text")
        messages = topics.read_request_stream(spark, fmt="text", path=f"{folder}/{name}_requests")
        _run_scoring(scoring.request_stream(messages), folder, name)
    return tables.read_keyed(spark, f"{folder}/table", ["uuid"], "timestamp").drop("timestamp")


@query(STATE_SQL, *ROUTED)
def stream_empty_batch(spark, sf_dir):
    """A micro-batch without rows leaves the state as it was."""
    folder = _scored_stream(spark, sf_dir)
    empty = request_ops.parse_requests(spark.read.text(f"{folder}/requests").limit(0), STREAM_REQUEST, keep_raw=True)
    model = rule_model()
    scoring.process_batch(
        empty, 0, lambda: model, scoring.keyed_table_sink(f"{folder}/table"), scoring.response_topic_sink(f"{folder}/topic", fmt="json")
    )
    return tables.read_keyed(spark, f"{folder}/table", ["uuid"], "timestamp").drop("timestamp")


@query(
    f"""SELECT uuid AS "UUID", route AS "Route", prediction AS "Prediction" FROM ({STORAGE_SQL})""", *ROUTED
)
def stream_response_topic(spark, sf_dir):
    """Messages of the response topic after the stream."""
    folder = _scored_stream(spark, sf_dir)
    schema = StructType.fromDDL("UUID string, Route string, Prediction double")
    return topics.read_topic(spark, schema, fmt="json", path=f"{folder}/topic")


@query(f'SELECT "UUID", {ERROR} AS error FROM requests WHERE NOT ({VALID})', *REQUESTS)
def stream_rejects(spark, sf_dir):
    folder = _scored_stream(spark, sf_dir)
    return spark.read.parquet(f"{folder}/rejected").select("UUID", "error")


@query(AWAIT_SQL, *REPEATED)
def stream_awaited_responses(spark, sf_dir):
    """Answered and timed-out requests of two streams.

    A last event far in the future moves the watermark past every limit.
    """
    folder = new_work_dir(spark)
    closing = spark.range(1).select(
        F.lit("closing").alias("UUID"),
        F.lit(None).cast("double").alias("Prediction"),
        F.expr("timestamp_ntz'2100-01-01 00:00:00'").alias("Timestamp"),
    )
    columns = ["UUID", "Prediction", "Timestamp"]
    asked = V.requests(spark, sf_dir).withColumn("Prediction", F.lit(None).cast("double")).select(*columns)
    answered = V.answers(spark, sf_dir).select(*columns)
    streams = []
    for name, rows in (("requests", asked), ("responses", answered)):
        rows.unionByName(closing).write.parquet(f"{folder}/{name}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/{name}")
        streams.append(stream.withColumn("Timestamp", F.col("Timestamp").cast("timestamp")))
    (
        status.await_response_stream(*streams)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/status")
        .awaitTermination()
    )
    result = spark.read.parquet(f"{folder}/status").filter(F.col("UUID") != "closing")
    return result.select(
        "UUID",
        F.col("Timestamp").cast("timestamp_ntz").alias("Timestamp"),
        "status",
        F.col("answered_at").cast("timestamp_ntz").alias("answered_at"),
        "Prediction",
    )
