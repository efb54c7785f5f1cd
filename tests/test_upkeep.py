"""Keyed tables with generations, versions, buckets, days, pages, cells, dictionaries, stream totals."""

import itertools
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from delaykit.catalogue import upkeep
from delaykit.operators import categories, clustering, counts, filters, lookups, ml, paging
from delaykit.sources import files, tables
from delaykit.streaming import status, totals
from tests.conftest import SMALL

ROWS = "uuid string, timestamp int, value double"


@pytest.fixture
def keyed(spark, tmp_path):
    root = str(tmp_path / "keyed")

    def put(rows, batch, writer="w"):
        tables.upsert_keyed(spark.createDataFrame(rows, ROWS), root, batch, writer)

    return root, put


def state(spark, root):
    return sorted(tuple(r) for r in tables.read_keyed(spark, root, ["uuid"], "timestamp").collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- generations -----------------------------------------------------------


def test_readers_follow_generations_and_later_batches(spark, keyed):
    root, put = keyed
    put([("a", 1, 1.0), ("b", 5, 1.0)], 0)
    put([("b", 4, 2.0), ("c", 1, 2.0)], 1)
    before = state(spark, root)
    assert tables.compact_keyed(spark, root, ["uuid"], "timestamp") == 1
    assert state(spark, root) == before == [("a", 1, 1.0), ("b", 5, 1.0), ("c", 1, 2.0)]
    assert tables.keyed_parts(spark, root).fresh == [] and tables.fresh_batches(spark, root) is None
    put([("a", 1, 3.0), ("d", 1, 3.0)], 2)  # equally late, written last
    put([("c", 0, 9.0)], 0, "other")  # older than what is stored
    assert state(spark, root) == [("a", 1, 3.0), ("b", 5, 1.0), ("c", 1, 2.0), ("d", 1, 3.0)]
    assert sorted(r.uuid for r in tables.fresh_batches(spark, root).collect()) == ["a", "c", "d"]
    # Only the generation and the batches since are read.
    files_read = tables.read_keyed(spark, root, ["uuid"], "timestamp").inputFiles()
    assert not [f for f in files_read if "writer=w/batch_id=0" in f or "writer=w/batch_id=1" in f]
    assert tables.compact_keyed(spark, root, ["uuid"], "timestamp") == 2
    assert state(spark, root) == [("a", 1, 3.0), ("b", 5, 1.0), ("c", 1, 2.0), ("d", 1, 3.0)]


def test_compaction_that_stops_half_way_changes_nothing(spark, keyed, monkeypatch):
    root, put = keyed
    put([("a", 1, 1.0)], 0)
    put([("a", 2, 2.0)], 1)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "COVERS", "bad\0name")
        with pytest.raises(Exception):
            tables.compact_keyed(spark, root, ["uuid"], "timestamp")
    parts = tables.keyed_parts(spark, root)
    assert parts.state is None and parts.last == 1 and state(spark, root) == [("a", 2, 2.0)]
    put([("a", 3, 3.0)], 2)
    assert tables.compact_keyed(spark, root, ["uuid"], "timestamp") == 2
    assert state(spark, root) == [("a", 3, 3.0)] and tables.keyed_parts(spark, root).fresh == []


def test_uncommitted_batches_are_left_out_and_repeats_are_read_again(spark, keyed, tmp_path):
    root, put = keyed
    put([("a", 1, 1.0)], 0)
    put([("b", 1, 1.0)], 1)
    (tmp_path / "keyed" / "writer=w" / "batch_id=1" / "_SUCCESS").unlink()
    assert state(spark, root) == [("a", 1, 1.0)]
    tables.compact_keyed(spark, root, ["uuid"], "timestamp")
    put([("b", 1, 1.0)], 1)
    put([("a", 1, 7.0)], 0)  # repeated with another value after it was compacted
    assert state(spark, root) == [("a", 1, 7.0), ("b", 1, 1.0)]
    with pytest.raises(ValueError):
        tables.compact_keyed(spark, str(tmp_path / "nothing"), ["uuid"])


def test_replaced_files_can_be_dropped(spark, keyed, tmp_path):
    root, put = keyed
    for k in range(3):
        put([("a", k, float(k)), (f"k{k}", 0, 0.0)], k)
        tables.compact_keyed(spark, root, ["uuid"], "timestamp")
    put([("new", 1, 1.0)], 3)
    before = state(spark, root)
    dropped = tables.drop_replaced(spark, root, keep=2)
    assert sorted(d.rsplit("/", 1)[-1] for d in dropped) == ["000000001", "batch_id=0", "batch_id=1"]
    assert state(spark, root) == before and len(before) == 5
    put([("k0", 0, 0.0), ("a", 0, 0.0)], 0)  # a stream that repeats its first batch
    assert state(spark, root) == before
    assert tables.compact_keyed(spark, root, ["uuid"], "timestamp") == 4 and state(spark, root) == before
    assert tables.drop_replaced(spark, root, keep=9) == []


# --- buckets and versions --------------------------------------------------


def test_stored_responses_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = upkeep.bucketed_status(spark, SMALL)
        lines = plan_of(found).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    stored = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
    depth = len(lines[stored]) - len(lines[stored].lstrip(" :+-*()0123456789"))
    # Walk up from the scan: each line with less indent is an operator above it.
    above = []
    for line in reversed(lines[:stored]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            above.append(line)
            depth = indent
        if "SortMergeJoin" in line and indent <= depth:
            break
    assert any("SortMergeJoin" in line for line in above) and not [line for line in above if "Exchange" in line]
    assert sum("Exchange" in line for line in lines) == 2  # requests, fresh responses


def test_status_of_stored_and_fresh_responses(spark):
    t = datetime(2024, 1, 1)
    schema = "UUID string, Timestamp timestamp, Prediction double"
    asked = spark.createDataFrame([(u,) for u in "abcdefg"], "UUID string")
    stored = spark.createDataFrame([("a", t, 1.0), ("b", t, 1.0), ("c", t, 1.0), ("g", None, 1.0)], schema)
    fresh = spark.createDataFrame(
        [("b", t, 2.0), ("c", t - timedelta(1), 2.0), ("d", t, 2.0), ("d", t + timedelta(1), 3.0), ("e", None, 2.0), ("g", t, 4.0)], schema
    )
    found = {r.UUID: (r.status, r.Prediction) for r in lookups.stored_status(asked, stored, fresh).collect()}
    assert found == {
        "a": ("OK", 1.0), "b": ("OK", 2.0), "c": ("OK", 1.0), "d": ("OK", 3.0), "e": ("OK", 2.0), "f": ("WAIT", None), "g": ("OK", 4.0),
    }
    assert lookups.stored_status(asked, stored).filter("status = 'OK'").count() == 4


@pytest.mark.parametrize("buckets", [None, (4, ["id"])])
def test_replacing_a_table_leaves_open_readers_and_failures_alone(spark, tmp_path, buckets):
    name = f"delay_test.versions_{'b' if buckets else 'p'}"
    put = lambda df: tables.replace_table(df, name, str(tmp_path), bucket_by=buckets)
    old = put(spark.range(5))
    new = put(spark.range(7))
    assert (old.count(), new.count(), spark.table(name).count()) == (5, 7, 7)
    broken = spark.range(3).select(F.raise_error(F.lit("down")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="down"):
        put(broken)
    with pytest.raises(ValueError, match="columns differ"):
        put(spark.range(3).withColumn("x", F.lit(1)))
    assert spark.table(name).count() == 7 and old.count() == 5
    assert [t.name for t in spark.catalog.listTables("delay_test") if t.name.startswith(name.split(".")[1])] == [name.split(".")[1]]
    put(spark.range(0))
    assert spark.table(name).count() == 0 and new.count() == 7


# --- days ------------------------------------------------------------------


def test_many_days_in_one_job(spark, tmp_path):
    root = str(tmp_path / "days")
    times = ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00", "2024-01-04 23:00:00", "2024-01-05 00:00:00", "2024-02-01 00:00:00"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(times)], "n int, t string").select("n", F.col("t").cast("timestamp_ntz").alias("Timestamp"))
    schema = df.schema
    found = lambda: sorted((str(r.iso_date), r.n) for r in files.read_days(spark, root, "2023-12-01", "2024-03-01", schema).collect())
    assert files.write_days(df, root, "2024-01-01", "2024-01-04") == [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 4)]
    first = [("2024-01-01", 0), ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 2), ("2024-01-04", 3), ("2024-01-04", 4)]
    assert found() == first
    # Each day equals the daily step; days outside the range stay, days without rows are emptied.
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        alone = filters.for_day(df, day)
        assert sorted(r.n for r in alone.collect()) == [n for d, n in found() if d == day]
    assert files.write_days(df.filter("n = 1"), root, "2024-01-01", "2024-01-02") == [date(2024, 1, 1)]
    assert found() == [("2024-01-01", 1), ("2024-01-04", 3), ("2024-01-04", 4)]
    files.write_days(df, root, "2024-01-01", "2024-01-02", inclusive=False)
    assert found()[:3] == [("2024-01-01", 0), ("2024-01-01", 1), ("2024-01-02", 2)]
    assert files.write_days(df.filter("false"), root, "2024-01-01", "2024-01-05") == [] and found() == []


# --- pages -----------------------------------------------------------------


def test_pages_by_cursor_equal_the_sorted_result(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]), rng.choice([None, 0.5, float("nan"), 2.0])) for _ in range(90)]
    rows += [(2, "x", 0.5)] * 25  # copies that fill more than a page
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    kinds = [(False, None), (True, None), (False, False), (True, True)]
    for (da, na), (db, nb), (dc, nc) in list(itertools.product(kinds, repeat=3))[::11]:
        order = [paging.Key("a", da, na), paging.Key("b", db, nb), paging.Key("c", dc, nc)]
        whole = [str(tuple(r)) for r in df.orderBy(*[k.order() for k in order]).collect()]
        cursor, got = None, []
        while True:
            page = paging.page_after(df, order, cursor, 40).collect()
            if not page:
                break
            got += [str(tuple(r)) for r in page]
            cursor = paging.cursor_after(page, order, cursor)
        assert got == whole
    assert paging.cursor_after([], order) is None
    with pytest.raises(ValueError):
        paging.page_after(df, [], None, 5)


def test_pages_inside_a_run_of_copies(spark):
    df = spark.createDataFrame([(1,)] * 7 + [(2,)], "k int")
    cursor, sizes = None, []
    for _ in range(4):
        page = paging.page_after(df, ["k"], cursor, 3).collect()
        sizes.append(len(page))
        cursor = paging.cursor_after(page, ["k"], cursor)
    assert sizes == [3, 3, 2, 0] and cursor == paging.Cursor({"k": 2}, 1)


def test_a_page_reaches_the_scan_as_a_bound(spark, tmp_path):
    path = str(tmp_path / "sorted")
    spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    page = paging.page_after(spark.read.parquet(path), ["id"], paging.Cursor({"id": 900}, 1), 5)
    plan = plan_of(page)
    assert "GreaterThanOrEqual(id,900)" in plan and "TakeOrderedAndProject" in plan
    assert [r.id for r in page.collect()] == [901, 902, 903, 904, 905]


def test_totals_beside_a_page_and_a_publication(spark, tmp_path):
    rows = spark.range(5000).filter("id % 7 = 0")  # known to be sorted, so a plain limit would stop early
    for cursor, wanted in ((None, [0, 7, 14]), (paging.Cursor({"id": 14}, 1), [21, 28, 35])):
        page, seen = paging.page_with_total(rows, ["id"], cursor, 3)
        assert page.columns == ["id"] and [r.id for r in page.collect()] == wanted and counts.total_of(seen) == 715
    table, n = tables.publish_counted(spark.range(12), "delay_test.counted")
    assert n == table.count() == 12
    assert tables.publish_counted(spark.range(0), "delay_test.counted")[1] == 0
    # Found to be empty at run time only.
    none = spark.range(100).filter("id < 0").repartition(3).groupBy("id").count().join(spark.range(50), "id")
    assert tables.publish_counted(none, "delay_test.none")[1] == 0


# --- cells -----------------------------------------------------------------


def files_of_scan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()) if leaves.apply(i).metrics().contains("numFiles"))


def test_each_criterion_prunes_files(spark, tmp_path):
    columns = ["a", "b", "c"]
    df = spark.range(6000).select(
        (F.col("id") % 13).alias("a"), (F.col("id") % 17).cast("string").alias("b"),
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise((F.col("id") % 29).cast("string")).alias("c"), "id",
    )
    df = df.unionByName(df.limit(5).withColumn("a", F.lit(None).cast("bigint")))
    path = str(tmp_path / "cells")
    clustering.write_clustered(df, path, columns, 2)
    stored = spark.read.parquet(path)
    everything = files_of_scan(stored)
    for criteria in ({"a": 5}, {"b": "11"}, {"c": "hot"}, {"c": "7"}):
        found = clustering.search_clustered(stored, criteria, columns, 2)
        assert found.columns == df.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, filters.search(df, criteria).collect())), criteria
        assert files_of_scan(found) <= everything / 2, criteria
    both = clustering.search_clustered(stored, {"a": 5, "b": "11"}, columns, 2)
    assert files_of_scan(both) <= everything / 8
    assert clustering.search_clustered(stored, {"a": None, "b": "", "id": 7}, columns, 2).count() == 1


def test_interleaved_bits(spark):
    row = spark.range(1).select(clustering.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z")).first()
    assert row.z == 0b011011


# --- categories ------------------------------------------------------------


def test_dictionary_gives_the_indexes_of_the_fitted_stage(spark):
    rng = random.Random(6)
    names = ["Carrier", "Origin", "Dest", "Route"]
    rows = [(rng.choice("ABBCCC"), rng.choice("XYZ"), rng.choice(["P", "Q", None]), f"r{rng.randrange(40)}") for _ in range(500)]
    df = spark.createDataFrame(rows, "Carrier string, Origin string, Dest string, Route string")
    dictionary = categories.category_dictionary(df, names)
    more = df.unionByName(spark.createDataFrame([("new", "X", None, "r0")], df.schema))
    mine = categories.with_category_indexes(more, dictionary, names)
    fitted = ml.index_categories(df).transform(more)
    assert mine.columns == fitted.columns
    assert mine.exceptAll(fitted).count() == fitted.exceptAll(mine).count() == 0
    empty = categories.category_dictionary(df.filter("false"), names)
    assert empty.count() == 0 and categories.with_category_indexes(df.limit(1), empty, names).first().Route_index == 0.0


# --- streams ---------------------------------------------------------------


def test_totals_of_late_rows_and_restarts(spark, tmp_path):
    rows, root, checkpoint = (str(tmp_path / n) for n in ("rows", "totals", "checkpoint"))

    def run(data):
        spark.createDataFrame(data, "Year int, Month int").write.mode("append").parquet(rows)
        stream = spark.readStream.schema("Year int, Month int").parquet(rows)
        totals.start_totals(stream, totals.MONTH, root, checkpoint, {"availableNow": True}).awaitTermination()
        return [tuple(r) for r in totals.months_of(spark, root).collect()]

    assert run([(2024, 2)] * 3 + [(2024, 1)]) == [(2024, 1, 1), (2024, 2, 3)]
    assert run([(2019, 12), (2024, 1)]) == [(2019, 12, 1), (2024, 1, 2), (2024, 2, 3)]
    tables.compact_keyed(spark, root, totals.MONTH, totals.TOTAL)
    assert run([(2024, 2), (None, 3)]) == [(None, 3, 1), (2019, 12, 1), (2024, 1, 2), (2024, 2, 4)]


def test_earliest_answer_within_the_time_counts(spark, tmp_path):
    """Early, repeated, equally late and disordered answers over several micro-batches: as the batch form."""
    t = datetime(2024, 1, 1)
    schema = "UUID string, Timestamp timestamp, Prediction double"
    at = lambda seconds: t + timedelta(seconds=seconds)
    asked = [[("a", at(0), None), ("b", at(1), None), ("c", at(2), None)], [("d", at(50), None), ("e", at(51), None)], [("f", at(400), None)]]
    answers = [
        [("a", at(-5), 9.0), ("a", at(5), 1.0), ("b", at(9), 2.0), ("b", at(4), 1.0), ("c", at(-1), 9.0)],
        # Later by arrival, earlier by event time; still within the delay.
        [("b", at(3), 0.5), ("d", at(57), 3.0), ("d", at(57), 1.0), ("d", at(52), 4.0), ("e", at(172), 1.0), ("stranger", at(60), 1.0)],
        [("f", at(520), 2.0), ("f", at(521), 1.0), ("f", at(399), 0.0)],
    ]

    def run():
        streams = [spark.readStream.schema(schema).parquet(f"{tmp_path}/{n}") for n in ("req", "resp")]
        query = (
            status.await_response_stream(*streams).writeStream.format("parquet")
            .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
        )
        query.awaitTermination()

    for requests, responses in zip([*asked, [("closing", at(9000), None)]], [*answers, [("closing", at(9000), 0.0)]]):
        spark.createDataFrame(requests, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/req")
        spark.createDataFrame(responses, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/resp")
        run()
    found = spark.read.parquet(f"{tmp_path}/out")
    batch = lookups.await_responses(
        spark.createDataFrame(sum(asked, []), schema), spark.createDataFrame(sum(answers, []), schema)
    )
    assert sorted(map(str, found.select(batch.columns).collect())) == sorted(map(str, batch.collect()))
    assert {r.UUID: (r.status, r.Prediction) for r in found.collect()} == {
        "a": ("ANSWERED", 1.0), "b": ("ANSWERED", 0.5), "c": ("TIMEOUT", None),
        "d": ("ANSWERED", 4.0), "e": ("TIMEOUT", None), "f": ("ANSWERED", 2.0),
    }
