"""Row filters and validation."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.functions.columns import all_of
from delaykit.schemas import NUMERIC_COLUMNS

REQUIRED_FIELDS = ["Origin", "Dest", "Carrier", "FlightDate"]
# Fixed value: message for a missing field.
MISSING_FIELD = "Falta el campo {}"


def drop_unlabelled(df: DataFrame) -> DataFrame:
    """Rows with both delays known."""
    return df.filter(F.col("ArrDelay").isNotNull() & F.col("DepDelay").isNotNull())


def for_day(df: DataFrame, iso_date: str, inclusive: bool = True, column: str = "Timestamp") -> DataFrame:
    """Rows of one day.

    ``inclusive`` also takes the first instant of the next day, so midnight
    belongs to two days; ``inclusive=False`` takes it once. The bounds are
    literals of the column's own type, so the source can use them to skip data.
    """
    start = date.fromisoformat(iso_date[:10])
    kind = df.schema[column].dataType
    low = F.lit(start.isoformat()).cast(kind)
    high = F.lit((start + timedelta(days=1)).isoformat()).cast(kind)
    value = F.col(column)
    return df.filter((value >= low) & ((value <= high) if inclusive else (value < high)))


def request_error(df: DataFrame, required=REQUIRED_FIELDS) -> Column:
    """Message naming the first missing field, null for a valid request.

    Null, empty text and NaN are missing.
    """
    error = F.lit(None).cast("string")
    for name in reversed(required):
        kind = df.schema[name].dataType.typeName()
        missing = F.col(name).isNull()
        if kind == "string":
            missing = missing | (F.col(name) == "")
        elif kind in ("double", "float"):
            missing = missing | F.isnan(name)
        error = F.when(missing, F.lit(MISSING_FIELD.format(name))).otherwise(error)
    return error


def split_valid(df: DataFrame, required=REQUIRED_FIELDS) -> tuple[DataFrame, DataFrame]:
    """Valid requests, and rejected ones with their ``error``."""
    checked = df.withColumn("error", request_error(df, required))
    valid = checked.filter(F.col("error").isNull()).drop("error")
    return valid, checked.filter(F.col("error").isNotNull())


def split_scorable(df: DataFrame, also=()) -> tuple[DataFrame, DataFrame]:
    """As ``split_valid``, and the numbers the model needs, and ``also``, must be there too.

    A null number would stop the whole batch in the vector assembler.
    """
    return split_valid(df, [*REQUIRED_FIELDS, *NUMERIC_COLUMNS, *also])


def search(df: DataFrame, criteria: dict, fields=None) -> DataFrame:
    """Rows equal to every given criterion; absent or empty ones are ignored.

    ``fields`` names the columns that may be searched.
    """
    allowed = set(df.columns if fields is None else fields)
    unknown = set(criteria) - allowed
    if unknown:
        raise ValueError(f"cannot search by {sorted(unknown)}")
    given = {name: value for name, value in criteria.items() if value not in (None, "")}
    return df.filter(all_of([F.col(name) == F.lit(value) for name, value in given.items()]))
