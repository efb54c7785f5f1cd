"""Scoring stream: sinks, restarts, replays, rejects; response status."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from delaykit.operators.requests import default_request
from delaykit.plans.requests import respond
from delaykit.schemas import INDEXED_STREAM_REQUEST, RESPONSE_NAMES, STREAM_REQUEST
from delaykit.sources import tables, topics
from delaykit.streaming import scoring, status

MESSAGE = {
    "UUID": "m0", "Origin": "BER", "Dest": "OSL", "Carrier": "ZX", "FlightDate": "2019-07-14", "FlightNum": "77",
    "DepDelay": 5, "Distance": 911, "DayOfWeek": 7, "DayOfYear": 195, "DayOfMonth": 14, "Timestamp": "2019-07-13T21:15:00",
}


@pytest.fixture
def model():
    case = "CASE WHEN DepDelay < 0 THEN 1.0 WHEN DepDelay < 30 THEN 2.0 ELSE 3.0 END"
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({case} AS DOUBLE) AS Prediction FROM __THIS__")])


class Flow:
    def __init__(self, spark, tmp_path, model):
        self.spark, self.root, self.model, self.files = spark, tmp_path, model, 0
        (tmp_path / "in").mkdir()

    def send(self, *messages):
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        (self.root / "in" / f"{self.files:03d}.txt").write_text("".join(line + "\n" for line in lines))
        self.files += 1

    def sinks(self):
        return (
            scoring.keyed_table_sink(f"{self.root}/table"),
            scoring.response_topic_sink(f"{self.root}/topic", fmt="json"),
            scoring.reject_sink(f"{self.root}/rejected"),
        )

    def run(self):
        table, topic, rejected = self.sinks()
        messages = topics.read_request_stream(self.spark, "text", path=f"{self.root}/in")
        query = scoring.start_scoring(
            scoring.request_stream(messages), lambda: self.model, table, topic, f"{self.root}/cp", rejected,
            {"availableNow": True},
        )
        query.awaitTermination()
        return query

    def table(self):
        return tables.read_keyed(self.spark, f"{self.root}/table", ["uuid"], "timestamp")


@pytest.fixture
def flow(spark, tmp_path, model):
    return Flow(spark, tmp_path, model)


def test_stream_equals_batch_and_goes_on_after_restart(spark, flow, model):
    first = [{**MESSAGE, "UUID": f"m{i}", "DepDelay": i - 20} for i in range(50)]
    flow.send(*first)
    flow.run()
    assert flow.table().count() == 50
    second = [{**MESSAGE, "UUID": f"n{i}", "DepDelay": None} for i in range(5)]
    flow.send(*second)
    flow.run()
    batch = topics.read_topic(spark, STREAM_REQUEST, fmt="text", path=f"{flow.root}/in")
    expected = respond(model, default_request(batch))
    assert flow.table().count() == 55
    assert flow.table().exceptAll(expected.select(flow.table().columns)).count() == 0
    assert spark.read.json(f"{flow.root}/topic").groupBy("batch_id").count().count() == 2


def test_restart_without_new_messages_writes_nothing(spark, flow):
    flow.send(MESSAGE)
    flow.run()
    before = spark.read.json(f"{flow.root}/topic").count()
    flow.run()
    assert spark.read.json(f"{flow.root}/topic").count() == before == 1


def test_bad_messages_are_rejected_and_the_rest_is_scored(spark, flow):
    flow.send(
        "not json",
        {**MESSAGE, "UUID": "no-dest", "Dest": ""},
        {**MESSAGE, "UUID": "no-distance", "Distance": "far"},
        {k: v for k, v in {**MESSAGE, "UUID": "no-delay"}.items() if k != "DepDelay"},
        MESSAGE,
    )
    flow.run()
    assert {r.uuid for r in flow.table().collect()} == {"m0", "no-delay"}
    rejected = {r.raw[:8]: r.error for r in spark.read.parquet(f"{flow.root}/rejected").collect()}
    errors = sorted(r.error for r in spark.read.parquet(f"{flow.root}/rejected").collect())
    assert rejected["not json"] == "Falta el campo Origin"
    assert errors == ["Falta el campo Dest", "Falta el campo Distance", "Falta el campo Origin"]


def test_replayed_batch_changes_nothing(spark, flow, model):
    lines = [json.dumps({**MESSAGE, "UUID": f"m{i}"}) for i in range(8)]
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    requests = scoring.request_stream(raw)
    table, topic, rejected = flow.sinks()
    for _ in range(2):
        scoring.process_batch(requests, 7, lambda: model, table, topic, rejected)
    assert spark.read.parquet(f"{flow.root}/table").count() == 8
    messages = spark.read.json(f"{flow.root}/topic")
    assert messages.count() == 8
    sent = json.loads(messages.first().value)
    assert set(RESPONSE_NAMES) | {"BatchId"} == set(sent) and sent["BatchId"] == 7


def test_empty_batch_reaches_no_sink(spark, model):
    def never(*_):
        raise AssertionError("an empty batch must not be written")

    empty = scoring.request_stream(spark.createDataFrame([], "value string"))
    scoring.process_batch(empty, 0, never, never, never, never)


def test_batch_is_released_when_a_sink_fails(spark, model):
    def fail(*_):
        raise RuntimeError("sink down")

    requests = scoring.request_stream(spark.createDataFrame([(json.dumps(MESSAGE),)], "value string"))
    with pytest.raises(RuntimeError):
        scoring.process_batch(requests, 0, lambda: model, fail, fail)
    assert not requests.is_cached


def test_indexed_messages_parse(spark):
    message = json.dumps({**MESSAGE, "Carrier_index": 2.0, "Route_index": None})
    row = scoring.request_stream(spark.createDataFrame([(message,)], "value string"), INDEXED_STREAM_REQUEST).first()
    assert row.Carrier_index == 2.0 and row.Route_index is None and row.Distance == 911.0


def test_console_tap(spark, flow):
    flow.send(MESSAGE)
    messages = topics.read_request_stream(spark, "text", path=f"{flow.root}/in")
    query = scoring.console_tap(scoring.request_stream(messages), trigger={"availableNow": True})
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 1


def test_response_status_stream(spark, tmp_path):
    t = datetime(2024, 1, 1)
    schema = "UUID string, Timestamp timestamp, Prediction double"

    def put(name, i, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    put("req", 0, [(f"u{i}", t + timedelta(seconds=i), None) for i in range(20)])
    answers = [(f"u{i}", t + timedelta(seconds=i + (5 if i < 8 else 121)), float(i)) for i in range(12)]
    put("resp", 0, answers + [("u0", t + timedelta(seconds=9), 99.0)])

    def run():
        streams = [spark.readStream.schema(schema).parquet(f"{tmp_path}/{n}") for n in ("req", "resp")]
        query = (
            status.await_response_stream(*streams)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{tmp_path}/cp")
            .trigger(availableNow=True)
            .start(f"{tmp_path}/out")
        )
        query.awaitTermination()
        return {r.UUID: (r.status, r.Prediction) for r in spark.read.schema(out).parquet(f"{tmp_path}/out").collect()}

    out = "UUID string, Timestamp timestamp, status string, answered_at timestamp, Prediction double"
    # All requests may still get an earlier answer than those that are there.
    assert run() == {}
    later = t + timedelta(hours=1)
    put("req", 1, [("closing", later, None)])
    put("resp", 1, [("stranger", later, 0.0)])
    final = run()
    assert len(final) == 20 and spark.read.parquet(f"{tmp_path}/out").count() == 20
    assert {k for k, v in final.items() if v[0] == "ANSWERED"} == {f"u{i}" for i in range(8)}
    assert final["u3"] == ("ANSWERED", 3.0) and final["u11"] == ("TIMEOUT", None)
