from datetime import datetime

import pytest
from pyspark.sql import functions as F

from delaykit import functions as DF


def one(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "hhmm, expected",
    [
        ("2400", "23:59"),
        ("2415", "23:59"),
        ("0005", "00:05"),
        ("905", "09:05"),
        ("1830", "18:30"),
        ("12345", None),
        (None, None),
    ],
)
def test_hhmm(spark, hhmm, expected):
    assert one(spark, DF.hhmm_to_time("t"), "t string", hhmm) == expected


@pytest.mark.parametrize(
    "date, hhmm, expected",
    [
        ("2015-12-31", "0305", datetime(2015, 12, 31, 3, 5)),
        ("2015-12-31", "2400", datetime(2015, 12, 31, 23, 59)),
        ("2015-12-31T00:00:00", "905", datetime(2015, 12, 31, 9, 5)),
        ("2015-02-30", "0305", None),
        ("2015-12-31", "ab12", None),
        ("2015-12-31", "0975", None),
        (None, "0305", None),
    ],
)
def test_event_timestamp(spark, date, hhmm, expected):
    assert one(spark, DF.to_event_ts("d", "t", ntz=True), "d string, t string", date, hhmm) == expected


def test_event_timestamp_is_utc_in_any_session_zone(spark):
    df = spark.createDataFrame([("2015-07-01", "0305")], "d string, t string")
    instant = df.select(F.unix_seconds(DF.to_event_ts("d", "t")))
    expected = instant.first()[0]
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert instant.first()[0] == expected == 1435719900
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_overnight_arrival_is_24_hours_later(spark):
    day = DF.to_event_ts("d", "dep", ntz=True), DF.to_event_ts("d", "arr", ntz=True)
    rolled = DF.roll_overnight(*day)
    schema = "d string, dep string, arr string"
    assert one(spark, rolled, schema, "2015-12-31", "2330", "0110") == datetime(2016, 1, 1, 1, 10)
    assert one(spark, rolled, schema, "2015-12-31", "0110", "0110") == datetime(2015, 12, 31, 1, 10)
    assert one(spark, rolled, schema, "2015-12-31", "2330", None) is None


def test_date_parts(spark):
    # 2015-12-31 was a Thursday.
    iso, zero = DF.date_parts("d"), DF.date_parts("d", "zero")
    values = [one(spark, iso[k], "d string", "2015-12-31") for k in ("DayOfYear", "DayOfMonth", "DayOfWeek")]
    assert values == [365, 31, 4]
    assert one(spark, zero["DayOfWeek"], "d string", "2016-12-25") == 6
    assert one(spark, iso["DayOfWeek"], "d string", "2016-12-25") == 7
    assert one(spark, iso["DayOfYear"], "d string", "no date") is None
    with pytest.raises(ValueError):
        DF.date_parts("d", "other")


def test_month_day_key(spark):
    key = DF.month_day_key()
    assert one(spark, key, "Month int, DayofMonth int", 12, 3) == "12-3"
    assert one(spark, key, "Month int, DayofMonth int", None, 3) is None


def test_route_is_null_if_an_end_is(spark):
    assert one(spark, DF.route(), "Origin string, Dest string", "ATL", "SFO") == "ATL-SFO"
    assert one(spark, DF.route(), "Origin string, Dest string", None, "SFO") is None


@pytest.mark.parametrize(
    "scheme, value, expected",
    [
        ("splits", 0.0, "Early (15+ Minutes Early)"),
        ("splits", 3.0, "Very Late (30+ Minutes Late)"),
        ("splits", 4.0, "Unknown"),
        ("splits", None, "Unknown"),
        ("live", 1.0, "On Time"),
        ("board", 2.0, "SLIGHT DELAY"),
        ("board", 9.0, "UNKNOWN"),
        ("batch", 2.0, "Very Late (60+ Minute Delay)"),
        ("batch", 3.0, "Unknown"),
    ],
)
def test_labels(spark, scheme, value, expected):
    assert one(spark, DF.delay_label("p", scheme), "p double", value) == expected


def test_label_of_text(spark):
    assert one(spark, DF.delay_label("p"), "p string", "2") == "Slightly Late (0-30 Minute Delay)"


@pytest.mark.parametrize("value, expected", [(0.0, "ok"), (1.0, "ok"), (2.0, "warn"), (3.0, "late"), (None, "warn")])
def test_severity(spark, value, expected):
    assert one(spark, DF.severity("p"), "p double", value) == expected


def test_first_present(spark):
    schema = "a string, b string"
    assert one(spark, DF.first_present(["a", "b"]), schema, "", "x") == "x"
    assert one(spark, DF.first_present(["a", "b"]), schema, "0.0", None) is None
    assert one(spark, DF.first_present(["a", "b"], keep_zero=True), schema, "0.0", None) == "0.0"
    assert one(spark, DF.first_present(["a", "b"]), schema, "y", "x") == "y"


def test_json_leaves_out_nulls(spark):
    assert one(spark, DF.encode_json("a", "b"), "a string, b double", "x", None) == '{"a":"x"}'
