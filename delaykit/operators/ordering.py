"""Sorting, paging, point lookups and samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.operators.copies import sort_whole
from delaykit.operators.filters import search

FEATURE_ORDER = ["DayOfYear", "Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime", "CRSArrTime"]
FLEET_ORDER = ["Owner", "Manufacturer", "Model", "EngineManufacturer", "EngineModel"]
# Rows per page of the two searches.
FLIGHT_PAGE = 15
FLEET_PAGE = 5


def sort_features(df: DataFrame) -> DataFrame:
    return sort_whole(df, FEATURE_ORDER)


def page(df: DataFrame, start: int, end: int, order_by) -> DataFrame:
    """Rows [start, end) of the sorted result.

    Needs a total order. The cost grows with ``end``: pages are for reading the
    top of a result, to walk through all of it use ``sort_features`` and files.
    """
    if not order_by:
        raise ValueError("a page needs an order")
    if not 0 <= start <= end:
        raise ValueError(f"bad page [{start}, {end})")
    return df.orderBy(*order_by).offset(start).limit(end - start)


def flights_of(flights: DataFrame, origin: str, dest: str, date: str) -> DataFrame:
    """Flights of a route and day."""
    return search(flights, {"Origin": origin, "Dest": dest, "FlightDate": date})


def list_flights(
    flights: DataFrame, origin: str, dest: str, date: str, order=("DepTime", "ArrTime")
) -> DataFrame:
    """Flights of a route and day in time order; ``row_count(flights_of(...))`` is their number."""
    return sort_whole(flights_of(flights, origin, dest, date), list(order))


def search_flights(flights: DataFrame, criteria: dict, start: int = 0, end: int = FLIGHT_PAGE) -> DataFrame:
    fields = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]
    found = search(flights, criteria, fields)
    return page(found, start, end, ["FlightDate", *[c for c in found.columns if c != "FlightDate"]])


def search_airplanes(airplanes: DataFrame, criteria: dict, start: int = 0, end: int = FLEET_PAGE) -> DataFrame:
    """A page of matching airplanes in fleet order, ties by tail number."""
    return page(search(airplanes, criteria), start, end, [*FLEET_ORDER, "TailNum"])


def prediction_history(responses: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` newest stored predictions, newest first."""
    return responses.orderBy(F.col("timestamp").desc(), "uuid").limit(n)


def find_one(df: DataFrame, criteria: dict, order=None) -> DataFrame:
    """First match by ``order``, by default all columns from left to right."""
    return search(df, criteria).orderBy(*(order or df.columns)).limit(1)


def sample_rows(df: DataFrame, fraction: float, seed: int = 27, key=None) -> DataFrame:
    """Share of the rows without replacement.

    By row position: the same sample for the same seed and partitioning. With
    ``key``, by hash of those columns: the same rows however they are laid out.
    """
    if key is None:
        return df.sample(False, fraction, seed)
    buckets = 1_000_000
    columns = [key] if isinstance(key, str) else list(key)
    return df.filter(F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(buckets)) < int(fraction * buckets))


def preview(df: DataFrame, n: int = 20, order=None) -> DataFrame:
    return (df if order is None else df.orderBy(*order)).limit(n)
