"""The three daily steps: fetch requests, score them, load the results."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from delaykit.operators.filters import split_scorable
from delaykit.operators.requests import default_request
from delaykit.plans.requests import score
from delaykit.schemas import BATCH_REQUEST
from delaykit.sources.documents import append_results, read_requests
from delaykit.sources.files import DAY_COLUMN, read_daily, read_days, write_daily, write_days

# Folders of the three steps.
TASKS = "prediction_tasks_daily.json"
RESULTS = "prediction_results_daily.json"
REJECTS = "prediction_rejects_daily.json"
RESULT = StructType(
    [
        *BATCH_REQUEST.fields,
        StructField("Route", StringType(), True),
        StructField("Prediction", DoubleType(), True),
    ]
)


def fetch_day(spark: SparkSession, iso_date: str, root: str, source: str | None, **source_options) -> None:
    """Copy one day of requests from the document store to that day's folder."""
    write_daily(read_requests(spark, source, iso_date, **source_options), f"{root}/{TASKS}", iso_date)


def score_day(spark: SparkSession, iso_date: str, root: str, model: PipelineModel) -> None:
    """Score the day's folder of requests into the day's folder of results.

    Requests that lack a field the model needs cannot be scored; they go to the day's folder of rejects, with
    the reason.
    """
    requests = read_daily(spark, f"{root}/{TASKS}", iso_date, BATCH_REQUEST)
    scorable, rejected = split_scorable(default_request(requests))
    write_daily(rejected, f"{root}/{REJECTS}", iso_date)
    write_daily(score(model, scorable), f"{root}/{RESULTS}", iso_date)


def day_results(spark: SparkSession, iso_date: str, root: str) -> DataFrame:
    return read_daily(spark, f"{root}/{RESULTS}", iso_date, RESULT)


def load_day(spark: SparkSession, iso_date: str, root: str, sink: str | None, **sink_options) -> None:
    """Append the day's results to the document store."""
    append_results(day_results(spark, iso_date, root), sink, **sink_options)


def fetch_days(spark: SparkSession, first: str, last: str, root: str, requests: DataFrame) -> None:
    """``fetch_day`` for each day from ``first`` to ``last``, in one job."""
    write_days(requests, f"{root}/{TASKS}", first, last)


def score_days(spark: SparkSession, first: str, last: str, root: str, model: PipelineModel) -> None:
    """``score_day`` for each day from ``first`` to ``last``: one job for the results, one for the rejects."""
    requests = read_days(spark, f"{root}/{TASKS}", first, last, BATCH_REQUEST)
    scorable, rejected = split_scorable(default_request(requests))
    for rows, folder in ((rejected, REJECTS), (score(model, scorable), RESULTS)):
        write_days(rows, f"{root}/{folder}", first, last, DAY_COLUMN, inclusive=False)


def days_results(spark: SparkSession, first: str, last: str, root: str) -> DataFrame:
    """Results of each day from ``first`` to ``last``, with their day."""
    return read_days(spark, f"{root}/{RESULTS}", first, last, RESULT)
