"""Response status in the stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.operators.lookups import WAIT_LIMIT, status_columns


def await_response_stream(
    requests: DataFrame, responses: DataFrame, timeout: str = WAIT_LIMIT, delay: str = "10 seconds"
) -> DataFrame:
    """Requests answered within ``timeout``, or timed out, as a stream.

    Both inputs need ``UUID`` and a ``Timestamp`` of type timestamp. Responses are joined to the time span of
    their request, and of those within it the earliest by event time counts, whatever their order of arrival:
    the join's rows go into a minimum per request. A request comes out once the watermark, ``delay`` behind the
    newest event, has passed its limit; until then it stays in the state of both steps, and no longer. The
    result is that of ``await_responses``, for events that are not later than ``delay``.
    """
    asked = requests.select("UUID", "Timestamp").withWatermark("Timestamp", delay)
    answers = responses.select(
        F.col("UUID").alias("__uuid"), F.col("Timestamp").alias("__at"), "Prediction"
    ).withWatermark("__at", delay)
    in_time = (
        (F.col("UUID") == F.col("__uuid"))
        & (F.col("__at") >= F.col("Timestamp"))
        & (F.col("__at") <= F.expr(f"Timestamp + INTERVAL {timeout}"))
    )
    # As a number the answer's time carries no watermark: the minimum follows the request's time alone.
    micros = F.unix_micros("__at").alias("micros")
    answer = F.when(F.col("__uuid").isNotNull(), F.struct(micros, "Prediction"))
    found = asked.join(answers, in_time, "left_outer").select("UUID", "Timestamp", answer.alias("__answer"))
    first = found.groupBy("UUID", "Timestamp").agg(F.min("__answer").alias("first"))
    return status_columns(first, F.timestamp_micros("first.micros"))
