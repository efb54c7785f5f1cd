"""Near duplicates by an inverted join of MinHash coordinates.

1. Each text gives its set of hashed shingles and ``COORDINATES`` minima under as many hash functions.
   Texts with equal sets form a class, which goes on as one row.
2. Classes are posted under every (coordinate, value) pair. Two classes whose sets are alike at the
   threshold agree in about that share of the pairs; fewer than ``MATCHES`` agreements rule them out.
3. *Skip*: a pair that one class alone holds is never read again. A class with fewer than ``MATCHES``
   shared pairs can have no partner.
4. *Prefix*: with all pairs in one global order, rarest first, two classes with ``MATCHES`` agreements meet
   in the first ``COORDINATES - MATCHES + 1`` pairs of each, so only these are joined. The longest lists,
   such as those of a passage that thousands of texts share, drop out.
5. In each list, all members are held against two others: the *centre*, which is the class with most
   company, and one picked by hash, which differs from list to list. That is linear in the list. Those that
   reach the threshold on their full sets are linked.
6. Members left outside the centre's component may still be linked with other members of the list. Those
   that are outside in any list, and the members of such lists, meet again under their rarest shingles: of two
   sets that reach the threshold, the larger one's first ``n - ceil(t n) + 1`` shingles and the smaller one's
   first ``n - ceil(2 t n / (1 + t)) + 1`` share one, and what is left of both from there on is enough for the
   overlap that they need. Texts on one template that are too unlike to be linked differ in more shingles than
   that, and as shingles of the template come last, such texts never meet, however many there are. Any order
   gives whole results; this one takes shingles by the counts of ``BINS`` bins over all sets, the rarest first.
   Pairs that meet count their agreements and then compare their full sets.

Components, not links, are the result, so pairs within a component found in step 5 are left out of step 6.
The chance that a pair exactly at the threshold has fewer agreements is below ``MISS`` (42 of 64 at 0.85, 38 at
0.8); pairs well above are safe.

Corner cases: texts that are null, empty or without words have an empty set and are linked with nothing;
one or two words form one shingle; equal texts, repeated rows and rows that share an id are one component;
a null id is kept, without component; an empty table gives no rows; other columns are not read. Where rows
with one id have different texts, the id stands for the set with the smallest hash.
"""

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import U64, mix, stored, words_of
from delaykit.llm.components import connected_components

WORDS = 3
PERCENT = 85
COORDINATES = 64
#: Chance that two sets exactly at the threshold agree too rarely to meet.
MISS = 5e-5
#: Bins of counted shingles, which every task holds: 8 bytes each.
BINS = 2**18
#: Entries of a batch that goes back to Spark.
ENTRIES = 100_000
#: Bytes of texts whose sets are held at once.
PIECE_BYTES = 2**22


def matches_for(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Agreements that two sets at the threshold have but for a chance of ``miss``: each coordinate agrees by itself."""
    p, below = percent / 100, 0.0
    for m in range(coordinates + 1):
        below += comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if below > miss:
            return max(1, m)
    return coordinates


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; one for all words if there are fewer."""
    hashed = [xxhash.xxh3_64_intdigest(w) for w in words_of(text)]
    if not hashed:
        return np.empty(0, np.uint64)
    ids = np.array(hashed, np.uint64)
    n = max(1, len(ids) - words + 1)
    found = np.full(n, U64(min(words, len(ids))))
    for k in range(min(words, len(ids))):
        found = mix(found) + ids[k : k + n]
    return np.unique(mix(found))


def hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
    return seeds[:n, None] | U64(1), seeds[n:, None]


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minimum of each hash function, mixed with its number: the key of its (coordinate, value) pair."""
    low = None
    for part in range(0, len(shingles), 4096):  # fits the cache, whatever the length of the text
        own = (shingles[None, part : part + 4096] * factors + shifts).min(1)
        low = own if low is None else np.minimum(low, own)
    return mix(low ^ shifts[:, 0])


def signed(docs: DataFrame, id_col: str, text_col: str, words: int, coordinates: int) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, keys) of each row; h1 and h2 stand for the whole set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        factors, shifts = hash_functions(coordinates)
        for batch in batches:
            sizes, h1, h2, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, words)
                sizes.append(len(found))
                h1.append(set_hash(found))
                h2.append(mix(found * U64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64))
                keys.append(signature(found, factors, shifts).view(np.int64) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(h1, np.uint64).view(np.int64)),
                    pa.array(np.array(h2, np.uint64).view(np.int64)),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "h1", "h2", "keys"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, h1 bigint, h2 bigint, keys array<bigint>")


def set_hash(shingles: np.ndarray) -> np.uint64:
    return shingles.sum(dtype=np.uint64)


def pieces(batch: pa.RecordBatch, size: int = PIECE_BYTES):
    """The rows of ``batch`` in order, in parts of about ``size`` bytes."""
    rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc_id, shingles) of the sets in ``wanted`` (doc_id, h1)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in (part for whole in batches for part in pieces(whole)):
            ids, sets = [], []
            for doc, text, h1 in zip(*(c.to_pylist() for c in batch.columns)):
                found = shingle_set(text, words)
                if set_hash(found).astype(np.int64) == h1:
                    ids.append(doc)
                    sets.append(found.view(np.int64))
            columns = [pa.array(ids, batch.column(0).type), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shingles"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(wanted.select("doc_id", "h1"), "doc_id")
    return rows.mapInArrow(run, f"doc_id {kind}, shingles array<bigint>")


def alike(percent: int) -> Column:
    both = F.size(F.array_intersect("sa", "sb"))
    return F.lit(100) * both >= F.lit(percent) * (F.size("sa") + F.size("sb") - both)


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``linked`` from the full sets.

    ``a``, which may stand in very many pairs, is joined while rows are small: with a set in each, they are
    then spread by ``b``.
    """
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select(*pairs.columns, alike(percent).alias("linked"))
    )


def postings(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(key, rep, n_shingles, weight): each class under the pairs of its prefix that others hold too."""
    rows = classes.select("rep", "n_shingles", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("company")).filter("company > 1")
    prefix = coordinates - matches + 1
    shared = rows.join(counts, "key").groupBy("rep", "n_shingles").agg(
        F.sort_array(F.collect_list(F.struct("company", "key"))).alias("pairs")  # at most one for each coordinate
    )
    # Pairs of one class alone come first in the order and so use up the prefix.
    first = F.slice("pairs", 1, F.lit(prefix - coordinates) + F.size("pairs"))
    weight = F.aggregate("pairs", F.lit(0).cast("bigint"), lambda a, p: a + p["company"])
    return (
        shared.filter(F.size("pairs") >= matches)
        .select("rep", "n_shingles", weight.alias("weight"), F.explode(first).alias("p"))
        .select(F.col("p.key").alias("key"), "rep", "n_shingles", "weight")
    )


def bin_of(shingles: np.ndarray) -> np.ndarray:
    """Bin of each hash; all of its bits are mixed, so the highest ones serve."""
    return (shingles.view(np.uint64) >> U64(64 - BINS.bit_length() + 1)).astype(np.int64)


def bin_counts(sets: DataFrame) -> np.ndarray:
    """Shingles of all sets in each of ``BINS`` bins; that many numbers reach the driver, whatever the input."""

    def run(batches):
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            counts += np.bincount(bin_of(batch.column(0).flatten().to_numpy()), minlength=BINS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bin", "n"])

    found = sets.select("shingles").mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BINS, np.int64)
    counts[found.column("bin").to_numpy()] = found.column("n").to_numpy()
    return counts


def rarest(met: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """``met`` (rep, part, outside, shingles) as (rep, part, outside, n, shingle, rest, first): a row for each shingle of
    the longer prefix, with the number of shingles from there on, and whether it is in the shorter prefix too."""
    kept = ["rep", "part", "outside"]
    kinds = {f.name: f.dataType.simpleString() for f in met.schema.fields}

    def run(batches):
        for batch in batches:
            rows, of, shingles, rest, first, held = batch.select(kept), [], [], [], [], 0
            for row, found in enumerate(batch.column("shingles")):
                found = found.values.to_numpy()
                n = len(found)
                longer = n + percent * n // -100 + 1
                shorter = n + 2 * percent * n // -(100 + percent) + 1
                chosen = found[np.lexsort((found, counts[bin_of(found)]))[:longer]]
                of.append(np.full(longer, row))
                shingles.append(chosen)
                rest.append(n - np.arange(longer))
                first.append(np.arange(longer) < shorter)
                held += longer
                if held >= ENTRIES:
                    yield entries(rows, of, shingles, rest, first)
                    of, shingles, rest, first, held = [], [], [], [], 0
            if held:
                yield entries(rows, of, shingles, rest, first)

    def entries(rows, of, shingles, rest, first):
        own = rows.take(pa.array(np.concatenate(of)))
        n = np.concatenate([np.full(len(r), r[0]) for r in rest])
        more = [pa.array(c) for c in (n, np.concatenate(shingles), np.concatenate(rest), np.concatenate(first))]
        return pa.RecordBatch.from_arrays([*own.columns, *more], [*kept, "n", "shingle", "rest", "first"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", n bigint, shingle bigint, rest bigint, first boolean"
    return met.select(*kept, "shingles").mapInArrow(run, schema)


def meeting_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b), once each, of two parts and at least one outside, that may reach the threshold by their rarest shingles."""
    x, y = entries.alias("x"), entries.filter("first").alias("y")
    larger = (F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.rep") < F.col("y.rep")))
    return (
        x.join(
            y,
            (F.col("x.shingle") == F.col("y.shingle"))
            & larger
            & (F.col("x.part") != F.col("y.part"))
            & (F.col("x.outside") | F.col("y.outside"))
            & (100 * F.col("y.n") >= percent * F.col("x.n"))
            & ((100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.n") + F.col("y.n"))),
        )
        .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
        .distinct()
    )


def star_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """(a, b), once each: the members b of every list with its centre and its other one, if their sizes allow a link.

    The intersection has at most the smaller set's size, the union at least the larger one's.
    """
    ends = placed.select(F.explode(F.array("centre", "other")).alias("end"), F.col("rep").alias("b"), "n_shingles")
    near = F.lit(100) * F.least("end.n_shingles", "n_shingles") >= F.lit(percent) * F.greatest("end.n_shingles", "n_shingles")
    return ends.filter(near).select(F.col("end.rep").alias("a"), "b").filter("a <> b").distinct()


def near_links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int, percent: int, coordinates: int, matches: int) -> DataFrame:
    """Edges (a, b) that join every component of alike classes."""
    posted = stored(postings(classes, coordinates, matches), "postings")
    wanted = posted.select("rep").distinct().join(classes, "rep").select(F.col("rep").alias("doc_id"), "h1")
    sets = stored(shingle_sets(docs, wanted, id_col, text_col, words), "sets")
    centres = (
        posted.groupBy("key")
        .agg(
            F.max(F.struct("weight", "rep", "n_shingles")).alias("top"),
            F.min(F.struct(F.xxhash64("key", "rep").alias("hash"), F.col("rep"), F.col("n_shingles"))).alias("any"),
            F.count(F.lit(1)).alias("members"),
        )
        .filter("members > 1")
        .select("key", *[F.struct(f"{c}.rep", f"{c}.n_shingles").alias(name) for c, name in (("top", "centre"), ("any", "other"))])
    )
    placed = posted.select("key", "rep", "n_shingles").join(centres, "key")
    linked = stored(compared(star_pairs(placed, percent), sets, percent).filter("linked").select("a", "b"), "stars")

    parts = connected_components(linked)
    placed = placed.withColumn("centre", F.col("centre.rep"))
    members = placed.filter("rep <> centre").join(parts, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "centre", F.coalesce("component", "rep").alias("part")
    )
    hearts = parts.select(F.col("node").alias("centre"), F.col("component").alias("heart"))
    members = members.join(hearts, "centre", "left").select("key", "rep", "part", (F.col("part") != F.coalesce("heart", "centre")).alias("outside"))
    members = stored(members, "members")
    lists = members.filter("outside").select("key").distinct()
    met = members.join(lists, "key", "left_semi").groupBy("rep", "part").agg(F.max("outside").alias("outside"))
    met = met.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    pairs = meeting_pairs(stored(rarest(met, bin_counts(sets), percent), "rarest"), percent)
    enough = (
        pairs.join(classes.select(F.col("rep").alias("a"), F.col("keys").alias("ka")), "a")
        .join(classes.select(F.col("rep").alias("b"), F.col("keys").alias("kb")), "b")
        .filter(F.size(F.array_intersect("ka", "kb")) >= matches)
        .select("a", "b")
    )
    more = compared(enough, sets, percent).filter("linked").select("a", "b")
    # A component's links are as good as one link from each member to its first.
    return parts.select(F.col("component").alias("a"), F.col("node").alias("b")).filter("a <> b").union(more)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    coordinates: int = COORDINATES,
    matches: int | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, under the id's own name.

    ``matches`` follows from ``percent`` unless given.
    """
    matches = matches_for(percent, coordinates) if matches is None else matches
    rows = stored(signed(docs, id_col, text_col, words, coordinates), "signed")
    same_set = ["h1", "h2", "n_shingles"]
    filled = rows.filter("n_shingles > 0 and doc_id is not null")
    again = stored(filled.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "again")
    chosen = filled.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*same_set, "keys")).alias("s"))
    single = filled.join(again, "doc_id", "left_anti").select("doc_id", *same_set, "keys").union(
        chosen.select("doc_id", "s.h1", "s.h2", "s.n_shingles", "s.keys")
    )
    classes = single.groupBy(*same_set).agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"))
    classes = stored(classes, "classes")
    links = near_links(docs, classes, id_col, text_col, words, percent, coordinates, matches)
    parts = connected_components(links)
    members = (
        single.select("doc_id", *same_set)
        .join(classes.drop("keys"), same_set)
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select("doc_id", F.coalesce("component", "rep").alias("component"))
    )
    found = rows.select("doc_id", "n_shingles").join(members, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the documents that are kept, in the columns of ``docs``.

    A document is an id and a text, so that rows with one id and unlike texts are compared, and kept, each on
    their own; of rows with equal id and text one stays, and rows without id all do.
    """
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text"))
    told = docs.select(F.when(F.col(id_col).isNotNull(), key).alias("key"), F.col(text_col).alias("text"))
    kept = near_duplicates(told, "key", "text", **options).filter("kept and key is not null").select("key").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    named = rows.filter(F.col("row")[id_col].isNotNull()).withColumn(
        "key", F.struct(F.col("row")[id_col].alias("id"), F.xxhash64(F.col("row")[text_col]).alias("text"))
    )
    one = named.join(kept, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row"))
    return one.select("row.*").union(rows.filter(F.col("row")[id_col].isNull()).select("row.*"))
