"""Schedule times and calendar parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_day_key(month="Month", day="DayofMonth") -> Column:
    """``'<month>-<day>'``; null if either part is null."""
    return F.concat(_col(month).cast("string"), F.lit("-"), _col(day).cast("string"))


def hhmm_to_time(hhmm) -> Column:
    """HHMM text to ``HH:MM``. Hour 24 is the last minute of the day, 23:59."""
    hhmm = _col(hhmm)
    digits = F.lpad(hhmm, 4, "0")
    hour = F.substring(digits, 1, 2)
    return (
        F.when(F.length(hhmm) > 4, F.lit(None).cast("string"))
        .when(hour == "24", F.lit("23:59"))
        .otherwise(F.concat(hour, F.lit(":"), F.substring(digits, 3, 2)))
    )


def to_event_ts(date, hhmm, ntz: bool = False) -> Column:
    """Date text and HHMM as a UTC timestamp; null when either is malformed.

    The text carries its own ``Z``, so the instant does not depend on the
    session time zone. ``ntz=True`` gives the UTC wall clock instead.
    """
    day = F.substring(_col(date).cast("string"), 1, 10)
    clock = F.concat(day, F.lit(" "), hhmm_to_time(hhmm), F.lit(":00"))
    if ntz:
        return clock.try_cast("timestamp_ntz")
    return F.concat(clock, F.lit("Z")).try_cast("timestamp")


def roll_overnight(departure, arrival) -> Column:
    """Arrival before departure means the next day (exactly 24 hours later)."""
    departure, arrival = _col(departure), _col(arrival)
    next_day = arrival + F.expr("INTERVAL '24' HOUR")
    return F.when(arrival < departure, next_day).otherwise(arrival)


def date_parts(date, convention: str = "iso") -> dict[str, Column]:
    """DayOfYear, DayOfMonth and DayOfWeek of a date.

    ``iso`` counts Monday as 1, like the training data; ``zero`` counts Monday
    as 0, like the request service. Use one convention on both sides of a model.
    """
    if convention not in ("iso", "zero"):
        raise ValueError(f"unknown convention: {convention}")
    day = F.substring(_col(date).cast("string"), 1, 10).try_cast("date")
    return {
        "DayOfYear": F.dayofyear(day),
        "DayOfMonth": F.dayofmonth(day),
        "DayOfWeek": F.weekday(day) + (1 if convention == "iso" else 0),
    }
