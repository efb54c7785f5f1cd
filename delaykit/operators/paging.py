"""Pages that begin after a row, with or without the number of all rows."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from delaykit.operators.counts import with_total
from delaykit.operators.filters import search
from delaykit.operators.ordering import FLEET_ORDER, FLEET_PAGE, FLIGHT_PAGE


@dataclass(frozen=True)
class Key:
    """A sort key. Nulls come first when ascending and last when descending, unless said otherwise."""

    name: str
    descending: bool = False
    nulls_first: bool | None = None

    @property
    def null_leads(self) -> bool:
        return (not self.descending) if self.nulls_first is None else self.nulls_first

    def order(self) -> Column:
        kind = ("desc" if self.descending else "asc") + ("_nulls_first" if self.null_leads else "_nulls_last")
        return getattr(F.col(self.name), kind)()

    def after(self, value) -> Column:
        """Rows that come later by this key alone."""
        column = F.col(self.name)
        if value is None:
            return column.isNotNull() if self.null_leads else F.lit(False)
        later = column < F.lit(value) if self.descending else column > F.lit(value)
        return later if self.null_leads else later | column.isNull()

    def not_before(self, value) -> Column:
        """The same with equal rows, in a form that sources can skip files by."""
        column = F.col(self.name)
        if value is None:
            return F.lit(True) if self.null_leads else column.isNull()
        here = column <= F.lit(value) if self.descending else column >= F.lit(value)
        return here if self.null_leads else here | column.isNull()


def keys_of(names) -> list[Key]:
    return [name if isinstance(name, Key) else Key(name) for name in names]


def after_row(order, last: dict, inclusive: bool = False) -> Column:
    """Rows that come after ``last`` in the order; with ``inclusive`` also those equal to it.

    The keys are compared as one value from left to right. The first key's bound is stated on its own as well,
    so that files sorted by it are skipped.
    """
    keys = keys_of(order)
    condition = F.lit(inclusive)
    for key in reversed(keys):
        condition = key.after(last[key.name]) | (F.col(key.name).eqNullSafe(F.lit(last[key.name])) & condition)
    return keys[0].not_before(last[keys[0].name]) & condition


@dataclass(frozen=True)
class Cursor:
    """Where a page ended: its last row's keys, and how many rows with these keys have been shown."""

    last: dict
    shown: int


def cursor_after(rows: list, order, before: Cursor | None = None) -> Cursor | None:
    """Cursor at the end of a page's ``rows``; that of the page ``before`` if there are none."""
    names = [key.name for key in keys_of(order)]
    if not rows:
        return before
    values = [{n: row[n] for n in names} for row in rows]
    shown = 0
    while shown < len(values) and _same(values[-1 - shown], values[-1]):
        shown += 1
    if before and shown == len(values) and _same(before.last, values[-1]):
        shown += before.shown
    return Cursor(values[-1], shown)


def _same(one: dict, other: dict) -> bool:
    """Equal as Spark compares: NaN is equal to NaN."""
    return all(one[n] == other[n] or (one[n] != one[n] and other[n] != other[n]) for n in one)


def page_after(df: DataFrame, order, cursor: Cursor | None, size: int, ties=()) -> DataFrame:
    """The next ``size`` rows of the sorted result.

    Unlike ``page``, rows before the cursor are filtered out instead of being sorted and counted, so that every
    page costs as much as the first. The order should tell all rows apart but exact copies: copies of the last
    row are skipped by their number, so only these count again. ``ties`` are sorted by after the order.
    """
    keys = keys_of(order)
    if not keys:
        raise ValueError("a page needs an order")
    rows = df if cursor is None else df.filter(after_row(keys, cursor.last, inclusive=True))
    rows = rows.orderBy(*[key.order() for key in [*keys, *keys_of(ties)]])
    if cursor is not None:
        rows = rows.offset(cursor.shown)
    return rows.limit(size)


def page_with_total(df: DataFrame, order, cursor: Cursor | None, size: int) -> tuple[DataFrame, Observation]:
    """``page_after`` and the number of all rows of ``df``, known by ``counts.total_of`` once the page was fetched.

    One scan gives both, which therefore is a whole one.
    """
    # A sort by more than the rows' known order, if they have one, has to see all of them.
    tie = "__page_tie"
    counted, seen = with_total(df.withColumn(tie, F.monotonically_increasing_id()), "matches")
    return page_after(counted, order, cursor, size, [tie]).drop(tie), seen


def flight_order(flights: DataFrame) -> list[Key]:
    return keys_of(["FlightDate", *[c for c in flights.columns if c != "FlightDate"]])


def next_flights(flights: DataFrame, criteria: dict, cursor: Cursor | None = None, size: int = FLIGHT_PAGE) -> DataFrame:
    """A page of matching flights by date."""
    fields = ["Carrier", "FlightDate", "Origin", "Dest", "TailNum", "FlightNum"]
    return page_after(search(flights, criteria, fields), flight_order(flights), cursor, size)


def next_airplanes(airplanes: DataFrame, criteria: dict, cursor: Cursor | None = None, size: int = FLEET_PAGE) -> DataFrame:
    """A page of matching airplanes in fleet order, ties by tail number."""
    return page_after(search(airplanes, criteria), keys_of([*FLEET_ORDER, "TailNum"]), cursor, size)
