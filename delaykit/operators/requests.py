"""Messages to typed requests."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaykit.functions import date_parts, encode_json


def parse_requests(df: DataFrame, schema: StructType, value: str = "value", keep_raw: bool = False) -> DataFrame:
    """Message bytes or text to flat columns.

    A malformed message has every field null, a bad field only that one;
    ``keep_raw`` keeps the text as ``raw`` so that it can be inspected.
    """
    parsed = df.select(
        F.col(value).cast("string").alias("raw"),
        F.from_json(F.col(value).cast("string"), schema).alias("data"),
    )
    return parsed.select("raw", "data.*") if keep_raw else parsed.select("data.*")


def encode_rows(df: DataFrame, columns=None, name: str = "value") -> DataFrame:
    """One JSON value per row, of all or the chosen columns."""
    return df.select(encode_json(*(columns or df.columns)).alias(name))


def default_request(df: DataFrame) -> DataFrame:
    """Typed request with defaults: delay 0.0, flight number ``"0"``."""
    return df.withColumns(
        {
            "DepDelay": F.coalesce(F.col("DepDelay").try_cast("double"), F.lit(0.0)),
            "FlightNum": F.coalesce(F.col("FlightNum").cast("string"), F.lit("0")),
        }
    )


def with_date_parts(df: DataFrame, convention: str = "iso", column: str = "FlightDate") -> DataFrame:
    return df.withColumns(date_parts(column, convention))


def stamp_requests(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Add the current ``Timestamp`` and a ``UUID``.

    With ``id_col`` the caller's id is kept and only missing ones are drawn, so
    a repeated request keeps its key. Drawn ids are random: write the stamped
    rows once and read them back before sending them to more than one place.
    """
    drawn = F.expr("uuid()")
    key = drawn if id_col is None else F.coalesce(F.nullif(F.col(id_col), F.lit("")), drawn)
    return df.withColumns({"UUID": key, "Timestamp": F.current_timestamp()})
