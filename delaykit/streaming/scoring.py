"""Request stream, micro-batch scoring into two sinks, console tap."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from delaykit.operators.filters import split_scorable
from delaykit.operators.projections import to_api
from delaykit.operators.requests import default_request, parse_requests
from delaykit.plans.requests import respond
from delaykit.schemas import STREAM_REQUEST
from delaykit.sources.tables import append_store, merge_keyed, stream_writer, upsert_keyed
from delaykit.sources.topics import RESPONSE_TOPIC, publish_json

Sink = Callable[[DataFrame, int], None]
MICRO_BATCH = "10 seconds"


def request_stream(messages: DataFrame, schema: StructType = STREAM_REQUEST) -> DataFrame:
    """Typed requests with the message text as ``raw``."""
    return parse_requests(messages, schema, keep_raw=True)


def keyed_table_sink(root: str) -> Sink:
    """Responses into a keyed table of files; a repeated batch replaces itself."""
    return lambda responses, batch_id: upsert_keyed(responses, root, batch_id, stream_writer(responses))


def response_topic_sink(topic: str = RESPONSE_TOPIC, fmt: str = "kafka", options: dict | None = None) -> Sink:
    """Responses as JSON messages keyed by UUID.

    A broker may get a batch again after a failure; ``BatchId`` lets readers
    tell. A file format writes one folder per batch, which a repeat replaces.
    """

    def write(responses: DataFrame, batch_id: int) -> None:
        messages = to_api(responses).withColumn("BatchId", F.lit(batch_id))
        if fmt == "kafka":
            publish_json(messages, topic, "UUID", fmt, options)
        else:
            publish_json(messages, f"{topic}/writer={stream_writer(responses)}/batch_id={batch_id}", "UUID", fmt, options, mode="overwrite")

    return write


def reject_sink(root: str) -> Sink:
    """Messages that cannot be scored, with the reason."""
    return lambda rejected, batch_id: upsert_keyed(
        rejected.select("raw", "UUID", "error"), root, batch_id, stream_writer(rejected)
    )


def store_sink(table: str, keyspace: str, **options) -> Sink:
    """Responses appended to a key-value store, where a repeated key replaces its row."""
    return lambda responses, batch_id: append_store(responses, table, keyspace, **options)


def merge_sink(table: str, keys: list[str], order_col: str) -> Sink:
    """Responses merged into a catalog table that supports MERGE."""
    return lambda responses, batch_id: merge_keyed(responses, table, keys, order_col)


def process_batch(
    batch: DataFrame,
    batch_id: int,
    get_model: Callable,
    table_sink: Sink,
    topic_sink: Sink,
    rejected_sink: Sink | None = None,
) -> None:
    """Score one micro-batch; it is read and scored once for all sinks."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if batch.isEmpty():
            return
        # Without an id nobody could be answered, and stored answers would fall together.
        valid, rejected = split_scorable(default_request(batch), ["UUID"])
        responses = respond(get_model(), valid).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # Table before topic: a client that sees the message finds the row.
            table_sink(responses, batch_id)
            topic_sink(responses, batch_id)
        finally:
            responses.unpersist()
        if rejected_sink is not None:
            rejected_sink(rejected, batch_id)
    finally:
        batch.unpersist()


def start_scoring(
    requests: DataFrame,
    get_model: Callable,
    table_sink: Sink,
    topic_sink: Sink,
    checkpoint: str,
    rejected_sink: Sink | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a stream from ``request_stream``; restarts go on from ``checkpoint``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, get_model, table_sink, topic_sink, rejected_sink)

    return (
        requests.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": MICRO_BATCH}))
        .foreachBatch(on_batch)
        .start()
    )


def console_tap(
    requests: DataFrame, interval: str = MICRO_BATCH, trigger: dict | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    """Print decoded messages every ``interval``; ``checkpoint`` is a folder all nodes share."""
    writer = requests.writeStream.outputMode("append")
    return (
        (writer.option("checkpointLocation", checkpoint) if checkpoint else writer)
        .format("console")
        .option("truncate", "false")
        .trigger(**(trigger or {"processingTime": interval}))
        .start()
    )
