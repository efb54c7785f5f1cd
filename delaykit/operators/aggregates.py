"""Totals, distributions and nested summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.operators.copies import sort_whole

AIRPLANE_FLIGHT = ["TailNum", "Carrier", "FlightDate", "FlightNum", "Origin", "Dest"]


def route_distances(flights: DataFrame, order: str | None = "asc") -> DataFrame:
    """Average distance per (Origin, Dest), by distance ``asc`` or ``desc``."""
    routes = flights.groupBy("Origin", "Dest").agg(F.avg("Distance").alias("Distance"))
    if order is None:
        return routes
    by = F.col("Distance").asc() if order == "asc" else F.col("Distance").desc()
    return routes.orderBy(by, "Origin", "Dest")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many, counted in one pass over the rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select(F.inline(pairs)).filter(F.col("nulls") > 0)


def prediction_distribution(df: DataFrame, column: str = "Prediction", rows: str | None = None) -> DataFrame:
    """Rows per class; ``rows`` names a column with the number that each row stands for."""
    return df.groupBy(column).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("n"))


def accuracy(df: DataFrame, prediction: str = "Prediction", label: str = "ArrDelayBucket") -> DataFrame:
    """Share of labelled rows whose prediction is the label."""
    right = (F.col(prediction) == F.col(label)).cast("double")
    return df.agg(F.avg(right).alias("accuracy"))


def flights_by_month(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("Year", "Month")
        .agg(F.count(F.lit(1)).alias("total_flights"))
        .orderBy("Year", "Month")
    )


def flights_per_airplane(flights: DataFrame) -> DataFrame:
    """One row per flight, sorted by airplane; the page of an airplane is a filter on ``TailNum``.

    Sorted files let that filter skip all but a few of them, and an airplane may have any number of flights.
    """
    return sort_whole(flights.select(AIRPLANE_FLIGHT), AIRPLANE_FLIGHT)


def airplane_totals(flights: DataFrame) -> DataFrame:
    return flights.groupBy("TailNum").agg(F.count(F.lit(1)).alias("FlightCount"))


def airplanes_per_carrier(flights: DataFrame) -> DataFrame:
    """One row per carrier and airplane; the fleet of a carrier is a filter on ``Carrier``."""
    return flights.filter(F.col("TailNum").isNotNull()).select("Carrier", "TailNum").distinct()


def fleet_totals(fleets: DataFrame) -> DataFrame:
    """Airplanes per carrier, from rows of ``airplanes_per_carrier``."""
    return fleets.groupBy("Carrier").agg(F.count(F.lit(1)).alias("FleetCount"))


def manufacturer_totals(airplanes: DataFrame) -> DataFrame:
    return (
        airplanes.groupBy("Manufacturer")
        .agg(F.count(F.lit(1)).alias("Total"))
        .orderBy(F.col("Total").desc(), "Manufacturer")
    )


def delay_histogram(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """Rows per bin as (bin, label, value); bins include their lower edge.

    ``edges`` cut the line into ``len(edges) + 1`` bins. Nulls and NaN have none.
    """
    edges = sorted(float(e) for e in edges)
    value = F.col(column).cast("double")
    bounds = [float("-inf"), *edges, float("inf")]
    labels = [f"[{low:g}, {high:g})" for low, high in zip(bounds, bounds[1:])]
    bin_number = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        bin_number = F.when(value < edges[i], F.lit(i)).otherwise(bin_number)
    counted = df.filter(value.isNotNull() & ~F.isnan(value)).groupBy(bin_number.alias("bin"))
    # The label depends on the bin only, so it is added to the few counted rows.
    names = F.element_at(F.array(*[F.lit(text) for text in labels]), F.col("bin") + 1)
    return (
        counted.agg(F.count(F.lit(1)).alias("value"))
        .select("bin", names.alias("label"), "value")
        .orderBy("bin")
    )


def distinct_rows(df: DataFrame, order=None) -> DataFrame:
    """Distinct rows, sorted afterwards so that the order is kept."""
    rows = df.distinct()
    return rows if order is None else rows.orderBy(*order)
