r"""How far the sources of a language are from each other and from the language, by their word counts.

Terms are maximal runs of ASCII letters and characters beyond ASCII, A-Z lower-cased; a language keeps those
that occur in at least ``LEAST_DOCS`` of its documents. Each group (language, source) and each language gives
each kept term a smoothed share p of ``ONE``, and the difference of a share p from another one q is priced
floor((p - q)^2 / q), in whole numbers throughout.

A group's p depends on the term's count alone, its level. The kept terms of a language are dealt into blocks;
in a block every (group, level) is an indicator column over the terms, and the matrix of these columns
multiplied by its transpose holds, for every pair of groups, how many terms have which pair of levels: the
joint tables. Each cell is priced once, times its number of terms. Count 0 is a level too; terms that occur in
none of the block's groups are priced by their number. Products run over parts of the block with few levels,
in float64, which holds these numbers exactly. Groups are dealt into blocks as well, so that a task holds
``BLOCK_TERMS`` terms of twice ``BLOCK_GROUPS`` groups at about, whatever their total number.

Words are counted in each task before anything is shuffled, so that a language, source or word that holds a
third of all rows moves one row for each task and term.

Corner cases: null text, language and source are empty ones; a language without kept terms has pairs of value 0
and no terms; a source alone in its language has no pairs; repeated rows count as documents of their own; texts
of any length are counted whole; bytes that are no UTF-8 are kept as they are; an empty table gives no rows;
other columns are not read.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.common import stored

LEAST_DOCS = 3
#: Fixed value: the whole that shares are parts of.
ONE = 1_000_000_000
TERM_RANKS = 200
BLOCK_TERMS, BLOCK_GROUPS = 512, 64
#: Columns of one matrix product, unless a single term has more.
COLUMNS = 512
#: Distinct (group, term) that a counting task holds before it sends them on.
HELD = 400_000
#: Bytes of terms as they are, A-Z lower-cased, all others blank.
LETTERS = bytes(b if 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs); each group has one row for the empty term as well."""

    def run(batches):
        words: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}

        def flush():
            for (lang, source), counts in words.items():
                listed = list(counts)
                own = docs[lang, source]
                for k in range(0, len(listed), 50_000):
                    part = listed[k : k + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(part), pa.string()),
                            pa.array([source] * len(part), pa.string()),
                            pa.array(part, pa.binary()),
                            pa.array([counts[t] for t in part], pa.int64()),
                            pa.array([own[t] for t in part], pa.int64()),
                        ],
                        ["lang", "source", "term", "n", "docs"],
                    )
            words.clear()
            docs.clear()

        seen = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = text.translate(LETTERS).split()
                found.append(b"")
                if (lang, source) not in words:
                    words[lang, source], docs[lang, source] = Counter(), Counter()
                own = words[lang, source]
                seen -= len(own)
                own.update(found)
                docs[lang, source].update(set(found))
                seen += len(own)
                if seen > HELD:
                    yield from flush()
                    seen = 0
        yield from flush()

    rows = docs.select(
        F.coalesce(lang_col, F.lit("")).alias("lang"),
        F.coalesce(source_col, F.lit("")).alias("source"),
        F.coalesce(text_col, F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(run, "lang string, source string, term binary, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, whole: Column) -> Column:
    """1 + floor(ONE * (n + 1) / whole); decimals, as the product may not fit a long."""
    wide = (n.cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)")) * F.lit(ONE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", wide, whole.cast("decimal(20,0)"))


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def level_products(levels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Price of each group of ``left`` (rows) by each of ``right`` (columns), summed over the terms.

    ``levels`` has the share of each term (row) in each group (column).
    """
    ordered = np.sort(levels, axis=0)
    fresh = np.ones(levels.shape, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    per_group = fresh.sum(0)
    if per_group.sum() > COLUMNS and len(levels) > 1:
        half = len(levels) // 2
        return level_products(levels[:half], left, right) + level_products(levels[half:], left, right)
    starts = np.concatenate([[0], np.cumsum(per_group)])
    price_of = ordered.T[fresh.T]
    column = np.empty(levels.shape, np.int64)
    for g in range(levels.shape[1]):
        column[:, g] = starts[g] + np.searchsorted(price_of[starts[g] : starts[g + 1]], levels[:, g])
    indicator = np.zeros((len(levels), len(price_of)))
    indicator[np.arange(len(levels))[:, None], column] = 1.0

    def of(groups):
        own = np.concatenate([np.arange(starts[g], starts[g + 1]) for g in groups])
        return own, np.concatenate([[0], np.cumsum(per_group[groups])[:-1]])

    (rows, row_starts), (columns, column_starts) = of(left), of(right)
    joint = (indicator[:, rows].T @ indicator[:, columns]).astype(np.int64)
    apart = price_of[rows][:, None] - price_of[columns][None, :]
    priced = joint * (apart * apart // price_of[columns][None, :])
    return np.add.reduceat(np.add.reduceat(priced, row_starts, axis=0), column_starts, axis=1)


def pair_sums(entries: DataFrame) -> DataFrame:
    """(lang, source, item, value, present, nothing) of each ordered pair of sources in each block.

    ``entries`` has (lang, block, left, right, source, side, term, p, p0): the kept terms' shares in the groups
    of two blocks of groups, and a row without term for each of these groups. ``present`` is the number of
    terms in the sums, ``nothing`` the price of a term that occurs in neither group.
    """

    def run(table: pa.Table) -> pa.Table:
        sources, at = np.unique(np.array(table["source"].to_pylist(), object), return_inverse=True)
        side, base = np.zeros(len(sources), np.int64), np.ones(len(sources), np.int64)
        side[at], base[at] = table["side"].to_numpy(), table["p0"].to_numpy()
        with_term = table["term"].is_valid().to_numpy()
        terms = table["term"].filter(table["term"].is_valid()).combine_chunks().dictionary_encode()
        levels = np.tile(base, (len(terms.dictionary), 1))
        p = table["p"].to_numpy(zero_copy_only=False)[with_term].astype(np.int64)
        levels[terms.indices.to_numpy(zero_copy_only=False), at[with_term]] = p
        # Terms of like counts share their levels.
        levels = levels[np.argsort(levels.sum(1), kind="stable")]
        first, second = np.flatnonzero(side == table["left"][0].as_py()), np.flatnonzero(side == table["right"][0].as_py())
        turns = [(first, second)] if table["left"][0] == table["right"][0] else [(first, second), (second, first)]
        out: list[tuple] = []
        lang = table["lang"][0].as_py()
        for one, other in turns:
            if not len(one) or not len(other):
                continue
            sums = level_products(levels, one, other) if len(levels) else np.zeros((len(one), len(other)), np.int64)
            for a, g in enumerate(one.tolist()):
                for b, h in enumerate(other.tolist()):
                    if g != h:
                        nothing = (int(base[g]) - int(base[h])) ** 2 // int(base[h])
                        out.append((lang, sources[g], sources[h], int(sums[a, b]), len(levels), nothing))
        types = [pa.string()] * 3 + [pa.int64()] * 3
        names = ["lang", "source", "item", "value", "present", "nothing"]
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    return entries.groupBy("lang", "block", "left", "right").applyInArrow(
        run, "lang string, source string, item string, value bigint, present bigint, nothing bigint"
    )


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS, block_terms: int = BLOCK_TERMS, block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: the divergence of a source from each other one of its language. Part ``term``: the terms that
    stand out most in a source against its language, to rank ``term_ranks``. Ties are ranked by item.
    """
    counted = stored(term_counts(docs, lang_col, source_col, text_col), "terms")
    found = counted.filter("octet_length(term) > 0")
    totals = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    totals = stored(totals.filter(F.col("docs") >= least_docs).drop("docs"), "kept")
    names = counted.filter("octet_length(term) = 0").select("lang", "source")
    size = totals.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("whole"))
    langs = (
        names.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).join(size, "lang", "left")
        .select(
            "lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("whole", F.lit(0)).alias("whole"),
            F.ceil(F.greatest(F.coalesce("terms", F.lit(0)), F.lit(1)) / block_terms).alias("term_blocks"),
            F.ceil(F.col("groups") / block_groups).alias("group_blocks"),
        )
    )
    langs = stored(langs, "langs")
    kept = totals.join(langs, "lang").select(
        "lang", "term", share(F.col("total"), F.col("whole") + F.col("terms")).alias("q")
    )
    entries = stored(found.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "entries")
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    all_words = F.coalesce("words", F.lit(0)) + F.col("terms")
    groups = names.join(sums, ["lang", "source"], "left").join(langs, "lang")
    groups = groups.select(
        "lang", "source", "terms", "term_blocks", "group_blocks", all_words.alias("words"),
        F.when(F.col("terms") > 0, share(F.lit(0), all_words)).otherwise(1).alias("p0"),
        F.pmod(F.xxhash64("source"), F.col("group_blocks")).alias("side"),
    )
    groups = stored(groups, "groups")
    shares = entries.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("words")))

    picked = shares.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), price(F.col("p"), F.col("q")).alias("value")
    )
    ranked = picked.withColumn("rank", rank()).filter(F.col("rank") <= term_ranks)

    # Each row goes to its block of terms, once for each block of groups that it is compared with.
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("group_blocks") - 1))
    placed = [F.least("side", "partner").alias("left"), F.greatest("side", "partner").alias("right")]
    own = shares.withColumn("block", F.pmod(F.xxhash64("term"), F.col("term_blocks"))).withColumn("partner", partner)
    marks = groups.withColumn("partner", partner).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("term_blocks") - 1))
    )
    both = own.select("lang", "block", *placed, "source", "side", "term", "p", "p0").unionByName(
        marks.select(
            "lang", "block", *placed, "source", "side",
            F.lit(None).cast("binary").alias("term"), F.lit(None).cast("bigint").alias("p"), "p0",
        )
    )
    pairs = pair_sums(both).groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"), F.sum("present").alias("present"), F.max("nothing").alias("nothing")
    )
    value = F.col("value") + (F.col("terms") - F.col("present")) * F.col("nothing")
    pairs = pairs.join(langs.select("lang", "terms"), "lang").select(
        "lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")
    )
    return pairs.withColumn("rank", rank()).unionByName(ranked)


def rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
