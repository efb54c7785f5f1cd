"""Tables laid out for searches by any of several columns.

Each column gives a few bits, of the hash of its value; the bits of all columns, interleaved, are the number of
a row's cell, and cells are folders. A search by some of the columns knows their bits, so that only the folders
whose numbers have them are listed for reading, whichever columns were given. Hashing deals out any type
evenly; a value that holds a third of all rows shares its bits with few others but is divided by the other
columns, and a cell is written by as many tasks as its rows need.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.operators.filters import search

CELL = "cell"
#: Rows of a written file, at most.
FILE_ROWS = 5_000_000


def hash_bits(value: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(1 << bits))


def interleaved(values: list[Column], bits: int) -> Column:
    """One number of the low ``bits`` of each value, taking a bit of each in turn."""
    number = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, value in enumerate(values):
            number = number.bitwiseOR(F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1)), bit * len(values) + i))
    return number


def cell_of(columns: list[str], bits: int) -> Column:
    return interleaved([hash_bits(F.col(c), bits) for c in columns], bits)


def write_clustered(df: DataFrame, path: str, columns: list[str], bits: int) -> None:
    """Write ``df`` in 2 ** (bits * number of columns) cells.

    About as many cells as the table has files of a good size keep files from getting small. Tasks take ranges
    of (cell, row), so that a large cell is cut over several of them.
    """
    rest = [F.col(c) for c in df.columns]
    placed = df.withColumn(CELL, cell_of(columns, bits)).repartitionByRange(CELL, *rest)
    placed.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).partitionBy(CELL).parquet(path)


def search_clustered(df: DataFrame, criteria: dict, columns: list[str], bits: int) -> DataFrame:
    """``search`` in a table of ``write_clustered`` with the same ``columns`` and ``bits``; reads matching cells only."""
    mask, wanted = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for i, name in enumerate(columns):
        if criteria.get(name) in (None, ""):
            continue
        value = hash_bits(F.lit(criteria[name]).cast(df.schema[name].dataType), bits)
        for bit in range(bits):
            place = bit * len(columns) + i
            mask = mask.bitwiseOR(F.lit(1 << place))
            wanted = wanted.bitwiseOR(F.shiftleft(F.shiftright(value, bit).bitwiseAND(F.lit(1)), place))
    cells = df.filter(F.col(CELL).cast("bigint").bitwiseAND(mask) == wanted)
    return search(cells, criteria, [c for c in df.columns if c != CELL]).drop(CELL)
