"""Column builders: every function here takes and returns Columns."""

from delaykit.functions.columns import encode_json, first_present, route, severity
from delaykit.functions.labels import LABEL_SCHEMES, delay_label
from delaykit.functions.times import (
    date_parts,
    hhmm_to_time,
    month_day_key,
    roll_overnight,
    to_event_ts,
)

__all__ = [
    "LABEL_SCHEMES",
    "date_parts",
    "delay_label",
    "encode_json",
    "first_present",
    "hhmm_to_time",
    "month_day_key",
    "roll_overnight",
    "route",
    "severity",
    "to_event_ts",
]
