"""Feature stages, forest, scoring and evaluation on MLlib."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.operators.projections import with_route
from delaykit.schemas import CATEGORY_COLUMNS, NUMERIC_COLUMNS

# Edges of the delay classes in minutes.
DELAY_SPLITS = [float("-inf"), -15.0, 0.0, 30.0, float("inf")]
INDEX_COLUMNS = [f"{name}_index" for name in CATEGORY_COLUMNS]
LABEL = "ArrDelayBucket"
PREDICTION = "Prediction"
FEATURES = "Features_vec"
# Number of rows that a counted row stands for, and what it weighs in a fit.
ROWS = "Rows"
WEIGHT = "Weight"


def delay_bucket(df: DataFrame, handle_invalid: str = "error") -> DataFrame:
    """Class of ``ArrDelay``, lower edge inclusive; null has none, NaN is invalid."""
    stage = Bucketizer(
        splits=DELAY_SPLITS, inputCol="ArrDelay", outputCol=LABEL, handleInvalid=handle_invalid
    )
    return stage.transform(df)


def index_categories(df: DataFrame, handle_invalid: str = "keep") -> StringIndexerModel:
    """Indexes of the category columns by falling frequency, all in one pass.

    ``keep`` gives unseen and null values an extra index, ``error`` refuses them.
    """
    return StringIndexer(
        inputCols=CATEGORY_COLUMNS,
        outputCols=INDEX_COLUMNS,
        stringOrderType="frequencyDesc",
        handleInvalid=handle_invalid,
    ).fit(df)


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    """Numbers and indexes as one vector; ``keep`` turns a null into NaN."""
    return VectorAssembler(
        inputCols=NUMERIC_COLUMNS + INDEX_COLUMNS, outputCol=FEATURES, handleInvalid=handle_invalid
    )


def trainable(features: DataFrame) -> DataFrame:
    """Rows a model can learn from, with route and class: no null or NaN number."""
    known = features
    for name in ["ArrDelay", *NUMERIC_COLUMNS]:
        value = F.col(name).cast("double")
        known = known.filter(value.isNotNull() & ~F.isnan(value))
    return delay_bucket(with_route(known))


def counted_rows(labelled: DataFrame, *also: str) -> DataFrame:
    """One row for all that are alike in what a model reads, in class and in ``also``, with their number."""
    return labelled.groupBy(*NUMERIC_COLUMNS, *CATEGORY_COLUMNS, LABEL, *also).agg(F.count(F.lit(1)).alias(ROWS))


def train(
    labelled: DataFrame,
    seed: int = 27,
    max_bins: int | None = None,
    max_memory_mb: int = 1024,
    handle_invalid: str = "keep",
    num_trees: int = 20,
    max_depth: int = 5,
    partitions: int = 64,
    counted: DataFrame | None = None,
) -> PipelineModel:
    """Index, assemble and fit the forest on rows from ``trainable``, dealt over ``partitions``.

    Bins must cover the largest category; they follow from the fitted indexes
    (one more for unseen values) unless given. Every row counts; where many are
    alike, those are drawn as two weighted ones, so that a fit costs by distinct rows.
    ``counted`` has the ``counted_rows`` of the same rows, where they are stored.
    """
    indexes = index_categories(labelled, handle_invalid)
    vectors = assembler()
    largest = max(len(labels) for labels in indexes.labelsArray) + 1
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        predictionCol=PREDICTION,
        maxBins=max_bins or max(32, largest),
        maxMemoryInMB=max_memory_mb,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
    )
    alike = counted_rows(labelled) if counted is None else counted
    if _many_alike(alike):
        forest.setWeightCol(WEIGHT)
        dealt = _dealt(alike, partitions).persist()
        ready = vectors.transform(indexes.transform(dealt)).select(FEATURES, LABEL, WEIGHT)
    else:
        every = vectors.transform(indexes.transform(labelled)).select(FEATURES, LABEL)
        ready = dealt = _spread(every, partitions).persist()
    # Kept, because the fit reads its rows several times.
    try:
        return PipelineModel(stages=[indexes, vectors, forest.fit(ready)])
    finally:
        dealt.unpersist()


def _spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even partitions that follow from the rows alone.

    The forest draws its samples by partition, so the number must not depend on the machine.
    """
    vector = F.xxhash64(F.to_json(F.struct(vector_to_array(FEATURES).alias("f"), F.col(LABEL).alias("l"))))
    return df.repartition(partitions, vector)


def _many_alike(counted: DataFrame) -> bool:
    """Whether two rows for each kind of row are at most half of all rows."""
    every, drawn = counted.agg(F.sum(ROWS), F.sum(F.least(F.col(ROWS), F.lit(2)))).first()
    return every is not None and every >= 2 * drawn


def _dealt(counted: DataFrame, partitions: int) -> DataFrame:
    """Weighted rows, of two halves where there are two rows or more, in even partitions.

    The forest draws its samples by partition and place there, so both follow from the rows alone. The halves
    leave at least one row more than the largest category has values, as bins ask for, where the rows had that.
    """
    columns = [*NUMERIC_COLUMNS, *CATEGORY_COLUMNS, LABEL]
    less = F.floor(F.col(ROWS) / 2)
    parts = F.filter(F.array(F.col(ROWS) - less, less), lambda n: n > 0)
    weighted = counted.select(*columns, F.explode(parts.cast("array<double>")).alias(WEIGHT))
    return weighted.repartition(partitions, *columns).sortWithinPartitions(*columns, WEIGHT)


def split_holdout(df: DataFrame, holdout: float = 0.2, seed: int = 27) -> tuple[DataFrame, DataFrame]:
    """(training, held-out) rows by hash of the row.

    The split does not depend on the layout of the data, and all copies of a
    row fall on one side, so that none of them leaks into the evaluation.
    """
    side = held_out_side(df, holdout, seed)
    return df.filter(~side), df.filter(side)


def held_out_side(df: DataFrame, holdout: float = 0.2, seed: int = 27) -> Column:
    """Whether ``split_holdout`` holds a row of ``df`` out."""
    return F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(1_000_000)) < int(holdout * 1_000_000)


def evaluate(model: PipelineModel, **splits: DataFrame) -> DataFrame:
    """Rows and accuracy of every named split, in one pass over their union; ``counted_rows`` stand for their number."""
    scored = None
    for name, df in splits.items():
        rows = F.col(ROWS) if ROWS in df.columns else F.lit(1).cast("long")
        part = model.transform(df).select(F.lit(name).alias("split"), PREDICTION, LABEL, rows.alias(ROWS))
        scored = part if scored is None else scored.unionByName(part)
    right = F.col(PREDICTION) == F.col(LABEL)
    known = F.sum(F.when(right.isNotNull(), F.col(ROWS)))
    share = F.sum(F.when(right, F.col(ROWS)).when(~right, 0)) / known
    return scored.groupBy("split").agg(F.sum(ROWS).alias("n"), share.alias("accuracy"))
