"""Topics: unbounded and bounded reads, JSON publishing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaykit.functions import encode_json
from delaykit.operators.requests import parse_requests

# Topic names of the request and response messages.
REQUEST_TOPIC = "flight-delay-ml-request"
RESPONSE_TOPIC = "flight-delay-ml-response"


def topic_options(servers: str, topic: str = REQUEST_TOPIC, starting: str = "latest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def read_request_stream(
    spark: SparkSession, fmt: str = "kafka", options: dict | None = None, path: str | None = None
) -> DataFrame:
    """Unbounded messages as a ``value`` column. ``fmt="text"`` follows a folder of JSON lines."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    return (reader.load(path) if path else reader.load()).select("value")


def read_topic(
    spark: SparkSession,
    schema: StructType,
    options: dict | None = None,
    fmt: str = "kafka",
    path: str | None = None,
) -> DataFrame:
    """All messages of a topic from its beginning, decoded."""
    options = dict(options or {})
    if fmt == "kafka":
        options.update(startingOffsets="earliest", endingOffsets="latest")
    reader = spark.read.format(fmt).options(**options)
    return parse_requests(reader.load(path) if path else reader.load(), schema)


def publish_json(
    df: DataFrame,
    sink: str,
    key: str | None = None,
    fmt: str = "kafka",
    options: dict | None = None,
    mode: str = "append",
) -> None:
    """Rows as JSON messages, keyed by ``key`` if given.

    ``sink`` is the topic, or the path of a file format. Text files hold the
    value only.
    """
    value = encode_json(*df.columns).alias("value")
    if key is None or fmt == "text":
        messages = df.select(value)
    else:
        messages = df.select(F.col(key).cast("string").alias("key"), value)
    writer = messages.write.format(fmt).mode(mode).options(**(options or {}))
    if fmt == "kafka":
        writer.option("topic", sink).save()
    else:
        writer.save(sink)
