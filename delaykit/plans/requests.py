"""Raw requests to scorable ones, and scored ones to responses."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from delaykit.operators.filters import split_valid
from delaykit.operators.lookups import with_distance
from delaykit.operators.ml import assembler
from delaykit.operators.projections import strip_ml_columns, to_storage, with_route
from delaykit.operators.requests import default_request, with_date_parts


def prepare_requests(
    requests: DataFrame, distances: DataFrame, default_distance: float | None = 0.0, convention: str = "iso"
) -> tuple[DataFrame, DataFrame]:
    """(scorable, rejected): validated, defaulted, with distance and calendar parts."""
    valid, rejected = split_valid(requests)
    enriched = with_distance(default_request(valid), distances, default_distance)
    return with_date_parts(enriched, convention), rejected


def score(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Requests with ``Route`` and ``Prediction``; batch and stream both use this."""
    return strip_ml_columns(model.transform(with_route(requests)))


def score_indexed(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Score requests whose sender already filled in the category indexes.

    Only the forest of the model is used; a missing number or index becomes NaN.
    """
    vectors = assembler("keep").transform(with_route(requests))
    return strip_ml_columns(model.stages[-1].transform(vectors))


def respond(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Scored requests as stored responses."""
    return to_storage(score(model, requests))
