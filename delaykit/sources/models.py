"""Fitted stages on disk or in an object store."""

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_version(spark: SparkSession, path: str):
    """Time of the last save, from the model's metadata files."""
    files = spark.read.format("binaryFile").load(f"{path}/metadata").select("modificationTime")
    return files.agg(F.max("modificationTime")).first()[0]


def model_provider(spark: SparkSession, path: str, refresh: bool = False):
    """Callable that gives the model: loaded once, with ``refresh`` again after each save."""
    held = {}

    def get() -> PipelineModel:
        version = model_version(spark, path) if refresh else None
        if "model" not in held or held["version"] != version:
            held.update(model=load_model(path), version=version)
        return held["model"]

    return get
