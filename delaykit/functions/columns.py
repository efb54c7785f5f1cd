"""Small column builders shared by the operators."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def route(origin="Origin", dest="Dest") -> Column:
    """``'<origin>-<dest>'``; null if either end is null."""
    return F.concat(F.col(origin), F.lit("-"), F.col(dest))


def encode_json(*columns) -> Column:
    """The columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns))


def first_present(values, keep_zero: bool = False) -> Column:
    """First value that is neither null nor empty text.

    Zero counts as missing unless ``keep_zero``. Values are read as text.
    """

    def usable(value):
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        filled = F.nullif(text, F.lit(""))
        if keep_zero:
            return filled
        return F.when(text.try_cast("double") == 0, F.lit(None)).otherwise(filled)

    return F.coalesce(*[usable(v) for v in values])


def severity(prediction) -> Column:
    """Display status of a class: 0 and 1 ok, 2 warn, 3 late, others warn."""
    value = (F.col(prediction) if isinstance(prediction, str) else prediction).try_cast("double")
    return F.when(value.isin(0.0, 1.0), "ok").when(value == 3, "late").otherwise("warn")


def all_of(conditions) -> Column:
    """Conjunction; true for no conditions."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
