"""Counts taken while rows are written, without a scan of their own."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def with_total(df: DataFrame, name: str = "total") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows on their way to whatever comes next, such as a write.

    ``total_of`` gives the count once an action has run. A step that may stop early, as a limit does, would
    count only what it took; ``paging.page_with_total`` counts beside a page.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def metrics_of(seen: Observation) -> dict:
    """What was observed; waits for the action.

    Nothing where adaptive execution found the rows to be none at all and left out the step that observes.
    """
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" in str(error.java_exception.getClass()):
            return {}
        raise


def total_of(seen: Observation) -> int:
    """Rows that passed."""
    return metrics_of(seen).get("n", 0)
