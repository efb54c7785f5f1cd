"""Column selection, typing and renaming."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaykit.functions import route
from delaykit.schemas import CATEGORY_COLUMNS, FEATURES, RESPONSE_NAMES, RESPONSE_TABLE

# Columns a scored row carries only for the model's sake: indexes, vector and what the classifier adds.
ML_COLUMNS = [f"{name}_index" for name in CATEGORY_COLUMNS] + ["Features_vec", "rawPrediction", "probability"]

# The names of flights that differ from those of features.
RENAMED = {"DayOfMonth": "DayofMonth"}
DERIVED = ("DayOfYear",)


def select_features(flights: DataFrame) -> DataFrame:
    """The feature columns, under the names the model uses."""
    names = [f.name for f in FEATURES.fields if f.name not in DERIVED]
    return flights.select([F.col(RENAMED.get(c, c)).alias(c) for c in names])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to ``schema``, in its column order. A value that cannot be cast is null.

    Columns of the schema that ``df`` lacks become null; others are dropped.
    """
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in schema.fields
        ]
    )


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn("Route", route())


def to_storage(df: DataFrame) -> DataFrame:
    """Scored rows under the stored names, typed as in the response table."""
    types = {f.name: f.dataType for f in RESPONSE_TABLE.fields}
    special = {
        # Dates may come with a time, which is cut off.
        "FlightDate": lambda c: F.substring(F.col(c).cast("string"), 1, 10).try_cast("date"),
        "Timestamp": lambda c: _as_time(df, c),
    }
    return df.select(
        [
            (special[shown](shown) if shown in special else F.col(shown).cast(types[stored])).alias(stored)
            for shown, stored in RESPONSE_NAMES.items()
        ]
    )


def _as_time(df: DataFrame, name: str):
    # A wall-clock column stays one; text and instants become instants.
    if df.schema[name].dataType.typeName() == "timestamp_ntz":
        return F.col(name)
    return F.col(name).try_cast("timestamp")


def to_api(df: DataFrame) -> DataFrame:
    """Stored responses under the names clients see."""
    return df.select([F.col(stored).alias(shown) for shown, stored in RESPONSE_NAMES.items()])


def strip_ml_columns(df: DataFrame) -> DataFrame:
    """Drop index, vector and model metadata columns, keep ``Prediction``."""
    return df.drop(*ML_COLUMNS)
