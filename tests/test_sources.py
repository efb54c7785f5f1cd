"""Files, tables, documents, topics, models, session."""

import bz2
import json
import os
from datetime import date, datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from delaykit.schemas import BATCH_REQUEST, FEATURES, STREAM_REQUEST
from delaykit.session import catalog_conf, new_work_dir, object_store_conf, shuffle_conf
from delaykit.sources import distances, documents, files, models, tables, topics

RECORD = {
    "ArrDelay": -3.0, "CRSArrTime": "2019-07-14T18:45:00.000+02:00", "CRSDepTime": "2019-07-14T16:30:00.000+02:00",
    "Carrier": "ZX", "DayOfMonth": 14, "DayOfWeek": 7, "DayOfYear": 195, "DepDelay": 2.0, "Dest": "OSL",
    "Distance": 911.0, "FlightDate": "2019-07-14T02:00:00.000+02:00", "FlightNum": "77", "Origin": "BER",
}


def test_compressed_json_with_schema(spark, tmp_path):
    path = tmp_path / "features.jsonl.bz2"
    path.write_bytes(bz2.compress((json.dumps(RECORD) + "\n").encode() * 3))
    df = files.read_features(spark, str(path))
    assert df.schema == FEATURES and df.count() == 3
    row = df.first()
    assert row.CRSDepTime == datetime(2019, 7, 14, 14, 30) and row.FlightNum == "77"


def test_inferred_json_profile(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"b": 1, "a": "x"}\n{"b": 2}\n')
    row = files.describe(files.read_json_inferred(spark, str(path))).first()
    assert row.n == 2 and row["columns"] == ["a", "b"]


def test_export_keeps_order_over_files(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.rand(1).alias("r"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.export_json(df, path, order_by=["n"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = sorted(f for f in os.listdir(path) if f.endswith(".json"))
    values = [json.loads(line)["n"] for f in names for line in open(os.path.join(path, f))]
    assert len(names) > 1 and values == list(range(5000))


def test_daily_write_replaces_only_its_day(spark, tmp_path):
    root = str(tmp_path / "daily")
    row = spark.createDataFrame([("AA", date(2024, 1, 1))], "Carrier string, FlightDate date")
    files.write_daily(row, root, "2024-01-01")
    files.write_daily(row.union(row), root, "2024-01-02T10:00:00")
    files.write_daily(row.union(row).union(row), root, "2024-01-01")
    one, two = (files.read_daily(spark, root, d, BATCH_REQUEST) for d in ("2024-01-01", "2024-01-02"))
    assert (one.count(), two.count()) == (3, 2)
    assert files.read_daily(spark, root, "2024-01-03", BATCH_REQUEST).count() == 0
    assert one.columns == BATCH_REQUEST.fieldNames()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(iso_date" in plan


def test_distances_with_either_spelling(spark, tmp_path, rows):
    path = tmp_path / "d.jsonl"
    lines = [
        '{"Origin": "ATL", "Dest": "SFO", "Distance": 2139}',
        '{"origin": "JFK", "dest": "LAX", "distance": "2475"}',
        '{"Origin": "", "origin": "BOS", "Dest": "LAX", "Distance": 2611.5}',
        '{"Origin": "ATL", "Distance": 10}',
        '{"Origin": "ATL", "Dest": "ATL", "Distance": 0}',
        "",
        "broken",
    ]
    path.write_text("\n".join(lines))
    found = rows(distances.load_distances(spark, str(path)))
    assert found == [("ATL", "SFO", 2139.0), ("BOS", "LAX", 2611.5), ("JFK", "LAX", 2475.0)]
    assert ("ATL", "ATL", 0.0) in rows(distances.load_distances(spark, str(path), keep_zero=True))


def test_keyed_table_survives_replays_and_compaction(spark, tmp_path, rows):
    root = str(tmp_path / "keyed")
    schema = "uuid string, timestamp int, prediction double"
    first = spark.createDataFrame([("a", 1, 0.0), ("b", 1, 0.0)], schema)
    second = spark.createDataFrame([("b", 2, 1.0), ("c", 2, 1.0)], schema)
    for batch_id, batch in ((0, first), (1, second), (1, second), (0, first)):
        tables.upsert_keyed(batch, root, batch_id)
    expected = [("a", 1, 0.0), ("b", 2, 1.0), ("c", 2, 1.0)]
    assert spark.read.parquet(root).count() == 4
    assert rows(tables.read_keyed(spark, root, ["uuid"], "timestamp")) == expected
    assert tables.compact_keyed(spark, root, ["uuid"], "timestamp") == 1
    assert rows(tables.read_keyed(spark, root, ["uuid"], "timestamp")) == expected
    tables.upsert_keyed(spark.createDataFrame([("a", 9, 3.0)], schema), root, 2)
    assert rows(tables.read_keyed(spark, root, ["uuid"], "timestamp"))[0] == ("a", 9, 3.0)


def test_published_table_is_replaced(spark):
    first = tables.publish_table(spark.range(5), "delay_test.numbers")
    assert first.count() == 5
    second = tables.publish_table(spark.range(7).toDF("other"), "delay_test.numbers", bucket_by=(4, ["other"]))
    assert second.count() == 7 and second.columns == ["other"]
    other = tables.publish_table(spark.range(7).toDF("other"), "delay_test.more", bucket_by=(4, ["other"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = second.join(other, "other")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    tables.register(second, "numbers_view")
    assert spark.sql("SELECT sum(other) FROM numbers_view").first()[0] == 21


def test_merge_statement_is_well_formed(spark):
    tables.publish_table(spark.range(2).withColumn("t", F.lit(1)), "delay_test.merged")
    updates = spark.range(3).withColumn("t", F.lit(2))
    # File tables cannot merge; a lakehouse catalog can. The refusal comes after parsing and binding.
    with pytest.raises(UnsupportedOperationException, match="does not support MERGE INTO TABLE"):
        tables.merge_keyed(updates, "delay_test.merged", ["id"], "t")


def test_document_store_round_trip(spark, tmp_path):
    source, sink = str(tmp_path / "requests"), str(tmp_path / "results")
    times = [datetime(2024, 1, d, 12) for d in (1, 2, 3)]
    spark.createDataFrame([(t,) for t in times], "Timestamp timestamp").write.parquet(source)
    day = documents.read_requests(spark, source, "2024-01-02", fmt="parquet")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Timestamp), GreaterThanOrEqual(Timestamp" in plan and "LessThanOrEqual(" in plan
    for batch in (day, day.limit(0), day):
        documents.append_results(batch, sink, fmt="parquet")
    assert spark.read.parquet(sink).count() == 2


def test_store_append_passes_table_and_keyspace(spark, monkeypatch):
    seen = {}
    original = DataFrameWriter.options
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **kw: seen.update(kw) or original(self, **kw))
    tables.append_store(spark.range(3), "responses", "delays", fmt="noop")
    assert seen == {"table": "responses", "keyspace": "delays"}


def test_topic_round_trip(spark, tmp_path):
    path = str(tmp_path / "topic")
    df = spark.createDataFrame([("u1", "ATL", 5.0), ("u2", None, None)], "UUID string, Origin string, DepDelay double")
    topics.publish_json(df, path, key="UUID", fmt="json")
    topics.publish_json(df, path, key="UUID", fmt="json")
    messages = spark.read.json(path)
    assert sorted(messages.columns) == ["key", "value"] and messages.count() == 4
    read = topics.read_topic(spark, STREAM_REQUEST, fmt="json", path=path)
    assert read.filter("UUID = 'u1' AND DepDelay = 5").count() == 2
    assert topics.topic_options("host:9092")["startingOffsets"] == "latest"


def _constant(value):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({value} AS DOUBLE) AS Prediction FROM __THIS__")])


def test_model_provider_reloads_only_when_asked(spark, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(_constant(1), path)
    fixed = models.model_provider(spark, path)
    fresh = models.model_provider(spark, path, refresh=True)
    value = lambda get: get().transform(spark.range(1)).first().Prediction
    assert (value(fixed), value(fresh)) == (1.0, 1.0)
    assert fresh() is fresh()
    models.save_model(_constant(2), path)
    assert (value(fixed), value(fresh)) == (1.0, 2.0)


def test_session_settings_come_from_the_environment(spark):
    env = {"OBJECT_STORE_ENDPOINT": "https://store", "OBJECT_STORE_ACCESS_KEY": "k", "OBJECT_STORE_SECRET_KEY": "s"}
    conf = object_store_conf(env)
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    assert object_store_conf({}) == {} and catalog_conf({}) == {}
    catalog = catalog_conf({"LAKEHOUSE_WAREHOUSE": "s3a://w", "CASSANDRA_HOST": "h"})
    assert catalog["spark.sql.catalog.lakehouse.warehouse"] == "s3a://w"
    assert catalog["spark.cassandra.connection.host"] == "h"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_shuffle_partitions_follow_the_data():
    assert shuffle_conf(1) == {"spark.sql.shuffle.partitions": "200"}
    assert shuffle_conf(20 * 1024**4) == {"spark.sql.shuffle.partitions": "40960"}


def test_work_dir_is_below_the_shared_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert new_work_dir(spark).startswith(before)
    assert new_work_dir(spark) != new_work_dir(spark)


def test_new_batches_never_replace_those_of_another_writer(spark, rows, tmp_path):
    root, schema = str(tmp_path / "keyed"), "uuid string, timestamp int, value double"
    put = lambda row, batch, writer: tables.upsert_keyed(spark.createDataFrame([row], schema), root, batch, writer)
    put(("a", 1, 1.0), 0, "old")
    put(("b", 1, 2.0), 0, "new")
    put(("a", 1, 0.5), 1, "new")  # equally late, written last
    assert rows(tables.read_keyed(spark, root, ["uuid"], "timestamp")) == [("a", 1, 0.5), ("b", 1, 2.0)]
    tables.upsert_keyed(spark.createDataFrame([], schema), root, 1, "new")
    assert rows(tables.read_keyed(spark, root, ["uuid"], "timestamp")) == [("a", 1, 1.0), ("b", 1, 2.0)]


def test_a_day_can_become_empty(spark, tmp_path):
    root, schema = str(tmp_path / "daily"), spark.createDataFrame([(1,)], "n int").schema
    for data in ([(1,)], []):
        files.write_daily(spark.createDataFrame(data, schema), root, "2024-01-01")
        assert files.read_daily(spark, root, "2024-01-01", schema).count() == len(data)


def test_one_distance_for_each_route(spark, rows, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"Origin":"X","Dest":"Y","Distance":5}\n{"origin":"X","dest":"Y","distance":7}\n')
    assert rows(distances.load_distances(spark, str(path))) == [("X", "Y", 7.0)]
