"""Text shown for a predicted delay class."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class -> label, one table per display.
# "splits" names the bucket edges -15, 0 and 30 minutes and is the default.
LABEL_SCHEMES = {
    "splits": {
        0: "Early (15+ Minutes Early)",
        1: "Slightly Early (0-15 Minute Early)",
        2: "Slightly Late (0-30 Minute Delay)",
        3: "Very Late (30+ Minutes Late)",
    },
    "live": {
        0: "Early / No Delay",
        1: "On Time",
        2: "Slightly Late (0-30 Minute Delay)",
        3: "Very Late (+30 Minute Delay)",
    },
    "board": {
        0: "EARLY",
        1: "ON TIME",
        2: "SLIGHT DELAY",
        3: "VERY LATE",
    },
    "batch": {
        0: "On Time (0-15 Minute Delay)",
        1: "Slightly Late (15-60 Minute Delay)",
        2: "Very Late (60+ Minute Delay)",
    },
}
UNKNOWN_LABELS = {"board": "UNKNOWN"}


def delay_label(prediction, scheme: str = "splits") -> Column:
    """Label of a class; anything outside the scheme is unknown."""
    value = F.col(prediction) if isinstance(prediction, str) else prediction
    value = value.try_cast("double")
    labels = None
    for number, text in LABEL_SCHEMES[scheme].items():
        hit = value == F.lit(float(number))
        labels = F.when(hit, text) if labels is None else labels.when(hit, text)
    return labels.otherwise(F.lit(UNKNOWN_LABELS.get(scheme, "Unknown")))
