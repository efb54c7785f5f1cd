"""Training from a stored feature table or JSON lines."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.operators.aggregates import null_profile, prediction_distribution
from delaykit.operators.ml import ROWS, counted_rows, evaluate, held_out_side, split_holdout, train, trainable
from delaykit.operators.projections import conform
from delaykit.schemas import FEATURES
from delaykit.session import new_work_dir
from delaykit.sources.files import read_json_inferred
from delaykit.sources.models import save_model
from delaykit.sources.tables import publish_table


def load_training_table(spark: SparkSession, path: str, table: str, provider: str = "iceberg") -> DataFrame:
    """JSON lines to a typed lakehouse table."""
    return publish_table(conform(read_json_inferred(spark, path), FEATURES), table, provider)


def train_job(
    features: DataFrame, model_path: str, seed: int = 27, holdout: float = 0.2, max_bins: int | None = None
) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Fit on the training split, save, and report.

    ``features`` is read several times (counts, indexes, nulls), so pass a
    stored table; forest and reports read the counted rows of both sides, which
    are stored in a working folder. Reports: nulls per column, accuracy on the
    rows trained on and on held-out ones, and the distribution of held-out predictions.
    """
    typed = conform(features, FEATURES)
    labelled = trainable(typed)
    stored = f"{new_work_dir(features.sparkSession)}/rows"
    sides = labelled.withColumn("HeldOut", held_out_side(labelled, holdout, seed))
    counted_rows(sides, "HeldOut").write.parquet(stored)
    counted = features.sparkSession.read.parquet(stored)
    fitting, held_out = counted.filter(~F.col("HeldOut")), counted.filter("HeldOut")
    model = train(split_holdout(labelled, holdout, seed)[0], seed=seed, max_bins=max_bins, counted=fitting)
    save_model(model, model_path)
    reports = {
        "nulls": null_profile(typed),
        "accuracy": evaluate(model, training=fitting, holdout=held_out),
        "distribution": prediction_distribution(model.transform(held_out), rows=ROWS),
    }
    return model, reports
