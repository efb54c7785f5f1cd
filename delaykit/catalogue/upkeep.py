"""Queries over tables that are kept up to date: buckets, generations, versions, days, stream totals, pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaykit.catalogue import views as V
from delaykit.catalogue.queries import (
    FLIGHTS, INDEXES_SQL, LABELLED_SQL, REQUESTS, UPSERTED_SQL, VALID, ROUTED, _labelled, _later_responses, _prepared, rule_model,
)
from delaykit.catalogue.registry import query
from delaykit.operators import categories, clustering, counts, filters, lookups, paging
from delaykit.plans import daily
from delaykit.plans.features import distance_job
from delaykit.schemas import CATEGORY_COLUMNS
from delaykit.session import new_work_dir
from delaykit.sources import files, tables
from delaykit.streaming import totals

BUCKETS = 8


def table_name(folder: str) -> str:
    return f"delaykit_{folder.rsplit('/', 1)[-1]}"


# --- keyed tables -----------------------------------------------------------


@query(
    """SELECT q."UUID", CASE WHEN r."UUID" IS NULL AND e % 3 <> 0 THEN 'WAIT' ELSE 'OK' END AS status,
      CASE WHEN e % 3 = 0 AND (r."UUID" IS NULL OR e % 9 = 0 OR e % 6 = 0) THEN e % 4 + 10.0
        ELSE r."Prediction" END AS "Prediction"
    FROM (SELECT *, CAST(substr("UUID", 5) AS BIGINT) AS e FROM requests) q LEFT JOIN responses r USING ("UUID")""",
    V.REQUESTS_SQL,
    V.RESPONSES_SQL,
)
def bucketed_status(spark, sf_dir):
    """Status by responses that are stored in buckets, and by those that came since."""
    folder = new_work_dir(spark)
    root = f"{folder}/responses"
    tables.upsert_keyed(V.responses(spark, sf_dir), root, 0)
    tables.compact_keyed(spark, root, ["UUID"], "Timestamp")
    current = tables.read_keyed(spark, root, ["UUID"], "Timestamp")
    stored = tables.publish_table(current, table_name(folder), bucket_by=(BUCKETS, ["UUID"]), location=f"{folder}/table")
    tables.upsert_keyed(_later_responses(V.all_responses(spark, sf_dir)), root, 1)
    return lookups.stored_status(V.requests(spark, sf_dir), stored, tables.fresh_batches(spark, root))


@query(UPSERTED_SQL, V.ALL_RESPONSES_SQL)
def compacted_state(spark, sf_dir):
    """State of a keyed table whose first batch was compacted before the second came, which then came again."""
    root = f"{new_work_dir(spark)}/responses"
    answered = V.all_responses(spark, sf_dir)
    later = _later_responses(answered)
    tables.upsert_keyed(answered, root, 0)
    tables.compact_keyed(spark, root, ["UUID"], "Timestamp")
    tables.upsert_keyed(later, root, 1)
    tables.compact_keyed(spark, root, ["UUID"], "Timestamp")
    tables.upsert_keyed(later, root, 1)
    return tables.read_keyed(spark, root, ["UUID"], "Timestamp")


@query(
    """SELECT "UUID", "Prediction", 'before' AS version FROM responses
    UNION ALL SELECT "UUID", "Prediction" + 10, 'after' FROM responses""",
    V.ALL_RESPONSES_SQL,
)
def replaced_table(spark, sf_dir):
    """What readers opened before and after a table's replacement see."""
    folder = new_work_dir(spark)
    name = table_name(folder)
    answered = V.all_responses(spark, sf_dir).select("UUID", "Prediction")
    before = tables.replace_table(answered, name, folder)
    newer = answered.withColumn("Prediction", F.col("Prediction") + 10)
    after = tables.replace_table(newer, name, folder)
    return before.withColumn("version", F.lit("before")).unionByName(after.withColumn("version", F.lit("after")))


@query(
    f"""SELECT CAST(d AS DATE) AS iso_date, "Origin", "Dest", coalesce("DepDelay", 0.0) AS "DepDelay",
      coalesce(t."Distance", 0.0) AS "Distance",
      CAST(CASE WHEN coalesce("DepDelay", 0.0) < -15 THEN 0.0 WHEN coalesce("DepDelay", 0.0) < 0 THEN 1.0
        WHEN coalesce("DepDelay", 0.0) < 30 THEN 2.0 ELSE 3.0 END AS DOUBLE) AS "Prediction"
    FROM (
      SELECT *, CAST("Timestamp" AS DATE) AS d FROM requests
      UNION ALL SELECT *, CAST("Timestamp" AS DATE) - 1 FROM requests WHERE "Timestamp" = CAST("Timestamp" AS DATE)
    ) LEFT JOIN distances t USING ("Origin", "Dest")
    WHERE {VALID} AND d BETWEEN (SELECT min(CAST(ts AS DATE)) FROM events) AND (SELECT max(CAST(ts AS DATE)) FROM events)""",
    *ROUTED,
)
def backfilled_days(spark, sf_dir):
    """All days of requests scored in two jobs, after a first run over rows that are then replaced."""
    root = new_work_dir(spark)
    asked = _prepared(spark, sf_dir)
    ends = V.table(spark, sf_dir, "events").agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    first, last = ends[0].isoformat(), ends[1].isoformat()
    daily.fetch_days(spark, first, last, root, asked.filter("Dest = 'NATION_2'"))
    daily.score_days(spark, first, last, root, rule_model())
    daily.fetch_days(spark, first, last, root, asked)
    daily.score_days(spark, first, last, root, rule_model())
    return daily.days_results(spark, first, last, root).select(
        files.DAY_COLUMN, "Origin", "Dest", "DepDelay", "Distance", "Prediction"
    )


@query(
    """SELECT 'flights published' AS step, count(*) AS n FROM flights
    UNION ALL SELECT 'routes loaded', count(*) FROM (SELECT DISTINCT "Origin", "Dest" FROM flights)
    UNION ALL SELECT 'flights found', count(*) FROM flights WHERE "Carrier" = 'RO' AND "Dest" = 'NATION_4'""",
    *FLIGHTS,
)
def observed_counts(spark, sf_dir):
    """Counts reported by the steps themselves: a publication, a load, and a page with its total."""
    folder = new_work_dir(spark)
    flights = V.flights(spark, sf_dir)
    published, n = tables.publish_counted(flights, table_name(folder), location=f"{folder}/flights")
    routes = distance_job(spark, published, f"{folder}/exported", f"{folder}/distances")
    found = filters.search(published, {"Carrier": "RO", "Dest": "NATION_4"})
    page, seen = paging.page_with_total(found, paging.flight_order(found), None, 15)
    page.collect()
    steps = [("flights published", n), ("routes loaded", routes), ("flights found", counts.total_of(seen))]
    return spark.createDataFrame(steps, "step string, n bigint")


# --- pages and searches -----------------------------------------------------

FLIGHT_PAGES = """SELECT * FROM flights WHERE "Carrier" = 'RO' AND "Dest" = 'NATION_4'
    ORDER BY "FlightDate", "FlightNum", "Year", "Month", "DayofMonth", "DayOfWeek", "Carrier", "TailNum",
      "Origin", "Dest", "Distance", "DepDelay" NULLS FIRST, "ArrDelay" NULLS FIRST, "CRSDepTime", "CRSArrTime"
    LIMIT 15 OFFSET 15"""


@query(FLIGHT_PAGES, *FLIGHTS)
def flight_search_next_page(spark, sf_dir):
    flights, criteria = V.flights(spark, sf_dir), {"Carrier": "RO", "Dest": "NATION_4"}
    first = paging.next_flights(flights, criteria).collect()
    return paging.next_flights(flights, criteria, paging.cursor_after(first, paging.flight_order(flights)))


@query(
    """SELECT * FROM airplanes ORDER BY "Owner", "Manufacturer", "Model", "EngineManufacturer", "EngineModel", "TailNum"
    LIMIT 5 OFFSET 10""",
    V.AIRPLANES_SQL,
)
def airplane_search_next_page(spark, sf_dir):
    """The third page, by the cursors of the two before."""
    airplanes = V.airplanes(spark, sf_dir)
    cursor = None
    for _ in range(2):
        shown = paging.next_airplanes(airplanes, {}, cursor).collect()
        cursor = paging.cursor_after(shown, [*paging.FLEET_ORDER, "TailNum"], cursor)
    return paging.next_airplanes(airplanes, {}, cursor)


@query(
    """SELECT "Route", "DepDelay", "UUID" FROM (SELECT *, "Origin" || '-' || "Dest" AS "Route" FROM requests)
    ORDER BY "DepDelay" DESC NULLS FIRST, "Route" NULLS LAST, "UUID" DESC LIMIT 100 OFFSET 2000""",
    *REQUESTS,
)
def request_page_after_nulls(spark, sf_dir):
    """A page of a mixed order that begins among rows without a delay."""
    rows = V.requests(spark, sf_dir).select(F.concat("Origin", F.lit("-"), "Dest").alias("Route"), "DepDelay", "UUID")
    order = [paging.Key("DepDelay", True, True), paging.Key("Route", False, False), paging.Key("UUID", True)]
    shown = paging.page_after(rows, order, None, 2000).collect()
    return paging.page_after(rows, order, paging.cursor_after(shown, order), 100)


SEARCH_COLUMNS = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]


def _clustered(spark, sf_dir) -> DataFrame:
    path = f"{new_work_dir(spark)}/flights"
    clustering.write_clustered(V.flights(spark, sf_dir), path, SEARCH_COLUMNS, 1)
    return spark.read.parquet(path)


@query("""SELECT * FROM flights WHERE "Carrier" = 'AF' AND "Origin" = 'NATION_7'""", *FLIGHTS)
def clustered_search(spark, sf_dir):
    criteria = {"Carrier": "AF", "Origin": "NATION_7", "Dest": "", "TailNum": None}
    return clustering.search_clustered(_clustered(spark, sf_dir), criteria, SEARCH_COLUMNS, 1)


# --- categories -------------------------------------------------------------


@query("SELECT column_name, value, idx FROM indexes", V.FLIGHTS_SQL, LABELLED_SQL, INDEXES_SQL)
def category_dictionary(spark, sf_dir):
    return categories.category_dictionary(_labelled(spark, sf_dir), CATEGORY_COLUMNS)


# --- totals kept by streams -------------------------------------------------


def _totals(spark, rows: DataFrame, keys: list[str], half) -> str:
    """Folder of the totals after one half of the rows, and after the other half and a restart."""
    folder = new_work_dir(spark)
    for part in (1, 0):
        rows.filter(half % 2 == part).select(keys).write.mode("append").parquet(f"{folder}/rows")
        stream = spark.readStream.schema(StructType([rows.schema[k] for k in keys])).parquet(f"{folder}/rows")
        totals.start_totals(stream, keys, f"{folder}/totals", f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    return f"{folder}/totals"


@query('SELECT "Year", "Month", count(*) AS total_flights FROM flights GROUP BY 1, 2', *FLIGHTS)
def stream_flights_by_month(spark, sf_dir):
    flights = V.flights(spark, sf_dir)
    return totals.months_of(spark, _totals(spark, flights, totals.MONTH, F.col("FlightNum").cast("int")))


@query('SELECT "Carrier", count(DISTINCT "TailNum") AS "FleetCount" FROM flights GROUP BY 1', *FLIGHTS)
def stream_fleet_totals(spark, sf_dir):
    flights = V.flights(spark, sf_dir)
    return totals.fleets_of(spark, _totals(spark, flights, totals.FLEET, F.col("FlightNum").cast("int")))


@query('SELECT "Manufacturer", count(*) AS "Total" FROM airplanes GROUP BY 1', V.AIRPLANES_SQL)
def stream_manufacturer_totals(spark, sf_dir):
    airplanes = V.airplanes(spark, sf_dir)
    return totals.manufacturers_of(spark, _totals(spark, airplanes, totals.MANUFACTURER, F.col("SerialNumber").cast("int")))
