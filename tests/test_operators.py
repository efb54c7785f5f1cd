"""Projections, filters, requests, copies, latest rows, lookups and aggregates."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaykit.operators import aggregates, copies, filters, latest, lookups, ordering, projections
from delaykit.operators import requests as request_ops
from delaykit.schemas import STREAM_REQUEST

FLIGHT = "TailNum string, Carrier string, FlightDate string, FlightNum string, Origin string, Dest string"


def test_conform_casts_adds_and_drops(spark, rows):
    df = spark.createDataFrame([("7", "2015-12-30T16:00:00.000-08:00", "x"), ("seven", "nope", "y")], "n string, d string, z string")
    out = projections.conform(df, StructType.fromDDL("d date, n int, other double"))
    assert out.columns == ["d", "n", "other"]
    assert rows(out) == [(None, None, None), (date(2015, 12, 30), 7, None)]


def test_storage_and_api_names_are_inverse(spark):
    schema = "UUID string, Origin string, Dest string, Carrier string, Route string, FlightDate string, DayOfWeek int, DayOfYear int, DayOfMonth int, DepDelay double, Distance double, Prediction double, Timestamp string"
    row = ("u", "BER", "OSL", "ZX", "BER-OSL", "2019-07-14", 7, 195, 14, 5.0, 911.0, 2.0, "2019-07-13T21:15:00")
    stored = projections.to_storage(spark.createDataFrame([row], schema))
    assert stored.first()["flight_date"] == date(2019, 7, 14)
    assert stored.first()["timestamp"] == datetime(2019, 7, 13, 21, 15)
    assert projections.to_api(stored).columns == [f.split()[0] for f in schema.split(", ")]


def test_strip_ml_columns(spark):
    df = spark.range(1).select("id", *[F.lit(1).alias(c) for c in projections.ML_COLUMNS], F.lit(2.0).alias("Prediction"))
    assert projections.strip_ml_columns(df).columns == ["id", "Prediction"]


def test_day_with_and_without_next_midnight(spark):
    times = ["2024-01-01T23:59:59", "2024-01-02T00:00:00", "2024-01-02T12:00:00", "2024-01-03T00:00:00"]
    typed = spark.createDataFrame([(datetime.fromisoformat(t),) for t in times], "Timestamp timestamp")
    assert filters.for_day(typed, "2024-01-02").count() == 3
    assert filters.for_day(typed, "2024-01-02", inclusive=False).count() == 2
    # ISO text compares as text: a day is smaller than any time of that day.
    text = spark.createDataFrame([(t,) for t in times], "Timestamp string")
    assert filters.for_day(text, "2024-01-02T08:00:00").count() == 2


def test_first_missing_field_gives_the_error(spark, rows):
    data = [
        ("ok", "A", "B", "C", "2024-01-01"),
        ("o", "", None, "C", "2024-01-01"),
        ("d", "A", "", None, "2024-01-01"),
        ("c", "A", "B", "", None),
        ("f", "A", "B", "C", ""),
    ]
    df = spark.createDataFrame(data, "id string, Origin string, Dest string, Carrier string, FlightDate string")
    valid, rejected = filters.split_valid(df)
    assert [r.id for r in valid.collect()] == ["ok"]
    assert rows(rejected, "id", "error") == [
        ("c", "Falta el campo Carrier"),
        ("d", "Falta el campo Dest"),
        ("f", "Falta el campo FlightDate"),
        ("o", "Falta el campo Origin"),
    ]


def test_search_ignores_absent_criteria(spark):
    df = spark.createDataFrame([("AA", 1), ("AA", 2), ("DL", 1)], "Carrier string, n int")
    assert filters.search(df, {}).count() == 3
    assert filters.search(df, {"Carrier": "AA", "n": None}).count() == 2
    assert filters.search(df, {"Carrier": "AA", "n": 2}).count() == 1
    with pytest.raises(ValueError):
        filters.search(df, {"Origin": "ATL"})
    with pytest.raises(ValueError):
        filters.search(df, {"n": 1}, fields=["Carrier"])


def test_malformed_messages_and_bad_fields(spark):
    messages = [
        b'{"UUID": "a", "DepDelay": 5, "Distance": 2139, "DayOfWeek": 7}',
        b"not json",
        b'{"UUID": "b", "DepDelay": "x", "DayOfWeek": 2}',
    ]
    df = spark.createDataFrame([(m,) for m in messages], "value binary")
    out = {r.raw: r for r in request_ops.parse_requests(df, STREAM_REQUEST, keep_raw=True).collect()}
    assert out[messages[0].decode()].DepDelay == 5.0
    assert all(v is None for k, v in out["not json"].asDict().items() if k != "raw")
    assert out[messages[2].decode()].DepDelay is None and out[messages[2].decode()].DayOfWeek == 2


def test_caller_ids_are_kept_and_others_drawn(spark):
    df = spark.createDataFrame([("mine",), ("",), (None,)], "rid string")
    stamped = request_ops.stamp_requests(df, "rid").collect()
    ids = [r.UUID for r in stamped]
    assert "mine" in ids and len(set(ids)) == 3 and all(r.Timestamp for r in stamped)
    assert request_ops.stamp_requests(df).filter("UUID = 'mine'").count() == 0


# --- copies -----------------------------------------------------------------


def test_whole_sort_spreads_copies_and_keeps_order(spark):
    data = [(1, "x")] * 400 + [(i % 7, f"s{i}") for i in range(800)]
    random.Random(3).shuffle(data)
    df = spark.createDataFrame(spark.sparkContext.parallelize(data, 40), "k int, s string")
    out = copies.sort_whole(df, [F.col("k").desc()])
    assert [tuple(r) for r in out.collect()] == sorted(data, key=lambda r: (-r[0], r[1]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in copies.sort_whole(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # A third of all rows are copies of one row, yet they are spread over several of 8 tasks.
    assert sum(sizes) == len(data) and max(sizes) < 250


def test_flights_per_airplane_are_sorted_rows(spark):
    data = [("N1", "AA", "2024-01-02", "7", "A", "B"), ("N1", "AA", "2024-01-01", "9", "B", "A"), ("N2", "DL", "2024-01-01", "1", "A", "C")]
    data = [*data, data[0], (None, "DL", "2024-01-01", "1", "A", "C")]
    df = spark.createDataFrame(data, FLIGHT)
    key = lambda r: (r[0] is not None, r)
    assert [tuple(r) for r in aggregates.flights_per_airplane(df).collect()] == sorted(data, key=key)
    totals = {r.TailNum: r.FlightCount for r in aggregates.airplane_totals(df).collect()}
    assert totals == {"N1": 3, "N2": 1, None: 1}


def test_airplanes_per_carrier_counts_distinct_tails(spark, rows):
    data = [("N1", "AA", "d", "1", "A", "B"), ("N1", "AA", "d", "2", "A", "B"), ("N3", "AA", "d", "3", "A", "B"), (None, "AA", "d", "3", "A", "B")]
    fleets = aggregates.airplanes_per_carrier(spark.createDataFrame(data, FLIGHT))
    assert rows(fleets) == [("AA", "N1"), ("AA", "N3")]
    assert rows(aggregates.fleet_totals(fleets)) == [("AA", 2)]
    airlines = spark.createDataFrame([("ZZ", "Other")], "CarrierCode string, Name string")
    assert rows(lookups.carrier_profile(airlines, fleets)) == [("AA", "N1", 2, None, None), ("AA", "N3", 2, None, None)]


# --- one row per key --------------------------------------------------------


def test_latest_and_first_match_brute_force(spark, rows):
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([None, *range(20)]), rng.randrange(1000)) for _ in range(600)]
    df = spark.createDataFrame(data, "k string, t int, v int").repartition(6)
    groups = defaultdict(list)
    for r in data:
        groups[r[0]].append(r)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    first = lambda r: (r[1] is None, r[1] or 0, r[2])
    order = lambda found: sorted(found, key=str)
    assert order(map(tuple, latest.latest_per_key(df, ["k"], "t").collect())) == order(max(g, key=key) for g in groups.values())
    assert order(map(tuple, latest.first_per_key(df, ["k"], "t").collect())) == order(min(g, key=first) for g in groups.values())


def test_update_wins_a_tie(spark, rows):
    now = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old"), ("c", 1, "old")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 4, "new"), ("d", 1, "new")], "k string, t int, v string")
    merged = latest.merge_latest(now, new, ["k"], "t")
    assert rows(merged) == [("a", 1, "new"), ("b", 5, "old"), ("c", 1, "old"), ("d", 1, "new")]


# --- lookups ----------------------------------------------------------------


def test_distance_default(spark, rows):
    asked = spark.createDataFrame([(1, "ATL", "SFO"), (2, "SFO", "ATL"), (3, None, "SFO")], "id int, Origin string, Dest string")
    known = spark.createDataFrame([("ATL", "SFO", 2139.0)], "Origin string, Dest string, Distance double")
    assert rows(lookups.with_distance(asked, known), "id", "Distance") == [(1, 2139.0), (2, 0.0), (3, 0.0)]
    assert rows(lookups.with_distance(asked, known, 1000.0), "id", "Distance")[1] == (2, 1000.0)
    assert rows(lookups.with_distance(asked, known, None), "id", "Distance")[1] == (2, None)


def test_hot_route_is_split_by_adaptive_execution(spark):
    """Two thirds of the requests ask for one route; the join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        asked = spark.range(0, 60_000, 1, 8).select(
            F.concat(F.lit("evt-"), F.col("id").cast("string")).alias("UUID"),
            F.when(F.col("id") % 3 > 0, "ATL").otherwise(F.concat(F.lit("A"), (F.col("id") % 500).cast("string"))).alias("Origin"),
            F.lit("SFO").alias("Dest"),
        )
        known = spark.createDataFrame([("ATL", "SFO", 2139.0)], "Origin string, Dest string, Distance double")
        found = lookups.with_distance(asked, known)
        assert len(found.collect()) == 60_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_wait_limit_is_inclusive(spark, rows):
    t = datetime(2024, 1, 1)
    asked = spark.createDataFrame([(u, t) for u in ("in", "edge", "late", "none", "early")], "UUID string, Timestamp timestamp")
    answers = [("in", 5), ("in", 9), ("edge", 120), ("late", 121), ("early", -1), ("stranger", 3)]
    answered = spark.createDataFrame([(u, float(s), t + timedelta(seconds=s)) for u, s in answers], "UUID string, Prediction double, Timestamp timestamp")
    out = lookups.await_responses(asked, answered)
    assert rows(out, "UUID", "status", "Prediction") == [
        ("early", "TIMEOUT", None),
        ("edge", "ANSWERED", 120.0),
        ("in", "ANSWERED", 5.0),
        ("late", "TIMEOUT", None),
        ("none", "TIMEOUT", None),
    ]
    assert rows(lookups.match_responses(asked, answered), "UUID", "Prediction") == [
        ("early", -1.0), ("edge", 120.0), ("in", 5.0), ("late", 121.0)
    ]
    # The status table is keyed, so the last response stands there.
    assert rows(lookups.request_status(asked, answered))[2] == ("in", "OK", 9.0)
    assert rows(lookups.request_status(asked, answered))[4] == ("none", "WAIT", None)


# --- aggregates and ordering ------------------------------------------------


def test_histogram_edges(spark, rows):
    values = [-15.1, -15.0, -0.1, 0.0, 29.9, 30.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    out = aggregates.delay_histogram(df, "d", [30, -15, 0])
    assert [tuple(r) for r in out.collect()] == [(0, "[-inf, -15)", 1), (1, "[-15, 0)", 2), (2, "[0, 30)", 2), (3, "[30, inf)", 1)]


def test_null_profile_lists_only_columns_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b int, c string")
    assert rows(aggregates.null_profile(df)) == [("b", 2), ("c", 1)]


def test_accuracy_skips_unlabelled(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, None)], "Prediction double, ArrDelayBucket double")
    assert aggregates.accuracy(df).first()[0] == 0.5


def test_page(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert [r.id for r in ordering.page(df, 5, 8, ["id"]).collect()] == [5, 6, 7]
    assert ordering.page(df, 98, 120, ["id"]).count() == 2
    with pytest.raises(ValueError):
        ordering.page(df, 0, 5, [])
    with pytest.raises(ValueError):
        ordering.page(df, 5, 4, ["id"])


def test_history_is_newest_first(spark):
    df = spark.createDataFrame([(f"u{i}", datetime(2024, 1, 1) + timedelta(hours=i % 40)) for i in range(80)], "uuid string, timestamp timestamp")
    out = ordering.prediction_history(df).collect()
    assert len(out) == 30 and [r.uuid for r in out][:3] == ["u39", "u79", "u38"]


def test_hash_sample_does_not_depend_on_layout(spark):
    df = spark.range(20_000)
    one = {r.id for r in ordering.sample_rows(df.repartition(3), 0.1, 27, "id").collect()}
    two = {r.id for r in ordering.sample_rows(df.repartition(7), 0.1, 27, "id").collect()}
    assert one == two and 1700 < len(one) < 2300
    assert one != {r.id for r in ordering.sample_rows(df, 0.1, 18, "id").collect()}
    assert 1700 < ordering.sample_rows(df, 0.1, 27).count() < 2300


def test_find_one_and_preview(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, n int")
    assert ordering.find_one(df, {"n": 2}).first().k == "a"
    assert ordering.find_one(df, {"n": 2}, [F.col("k").desc()]).first().k == "b"
    assert ordering.preview(df, 2).count() == 2


def test_an_answer_before_the_request_does_not_hide_a_later_one(spark):
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    asked = spark.createDataFrame([("a", at(10)), ("b", at(10))], "UUID string, Timestamp timestamp_ntz")
    answered = spark.createDataFrame([("a", at(5), 1.0), ("a", at(15), 2.0), ("b", at(5), 3.0)], "UUID string, Timestamp timestamp_ntz, Prediction double")
    out = {r.UUID: (r.status, r.Prediction) for r in lookups.await_responses(asked, answered).collect()}
    assert out == {"a": ("ANSWERED", 2.0), "b": ("TIMEOUT", None)}
