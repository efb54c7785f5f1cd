"""Raw schedule rows to model features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.functions import roll_overnight, to_event_ts
from delaykit.operators.aggregates import route_distances
from delaykit.operators.counts import total_of, with_total
from delaykit.operators.filters import drop_unlabelled
from delaykit.operators.ordering import sample_rows, sort_features
from delaykit.operators.projections import conform, select_features
from delaykit.schemas import FEATURES
from delaykit.sources.distances import load_distances
from delaykit.sources.files import export_json, read_flights
from delaykit.sources.tables import upsert_keyed


def derive_features(selected: DataFrame, ntz: bool = False) -> DataFrame:
    """Schedule times as UTC timestamps, arrival after departure, typed calendar parts."""
    timed = selected.withColumns(
        {
            "CRSDepTime": to_event_ts("FlightDate", "CRSDepTime", ntz),
            "CRSArrTime": to_event_ts("FlightDate", "CRSArrTime", ntz),
        }
    )
    return timed.withColumns(
        {
            "CRSArrTime": roll_overnight("CRSDepTime", "CRSArrTime"),
            "DayOfYear": F.dayofyear(F.col("FlightDate").try_cast("date")),
        }
    )


def extract_features(
    flights: DataFrame, fraction: float | None = None, seed: int = 27, key=None
) -> DataFrame:
    """Features of labelled flights, unsorted; rows are filtered before they are sampled."""
    kept = drop_unlabelled(select_features(flights))
    if fraction is not None:
        kept = sample_rows(kept, fraction, seed, key)
    return conform(derive_features(kept), FEATURES)


def feature_job(spark, source: str, target: str, fraction: float | None = None, seed: int = 27) -> None:
    """On-time table to sorted, compressed JSON lines."""
    features = sort_features(extract_features(read_flights(spark, source), fraction, seed))
    export_json(features, target, compression="gzip")


def distance_job(spark, flights: DataFrame, exported: str, root: str, batch_id: int | str = 0) -> int:
    """Average distance per route as JSON lines, and from there as a batch of the keyed table that requests look up.

    Read the table by ``read_keyed`` on (Origin, Dest): requests then never average the flights again. Returns
    the number of routes loaded, counted as they are written.
    """
    export_json(route_distances(flights, None), exported, order_by=["Distance"])
    loaded, seen = with_total(load_distances(spark, exported), "loaded")
    upsert_keyed(loaded, root, batch_id)
    return total_of(seen)
