"""Importance resampling of raw text towards a target.

Words and pairs of words are hashed into ``BUCKETS`` bins. The counts of the bins over the target documents
and over all documents are two generative models; a document's weight is the log-ratio of its probability
under them. Adding Gumbel noise to the log-weights and taking the largest ``k`` draws k documents without
replacement, with chances in proportion to their weights. The noise is a hash of the id and the text, so
that a task that is run again draws the same.

One pass counts the bins of all documents where they lie, and puts aside the bins of documents whose id may
be a target's: a Bloom filter of ``FILTER_BITS`` over the target ids, the same at every size, tells which. Only
these are then joined with the target ids, always by sorting both sides, so that what moves grows with the
target documents. A filter that many more ids than an eighth of its bits have filled lets more documents
through to the exact join, which still decides.

What reaches the driver is two numbers for each bin, the filter, and one number for each task of the sort.

Corner cases: a null or empty text has no features and weight 0; rows with equal id and text get the same
noise, and exactly k rows are kept among them too; a null id takes part but is never a target; without target
documents both models are flat; an empty table gives no rows; other columns are not read.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import U64, mix, stored, words_of
from delaykit.operators.numbering import numbered

BUCKETS = 10_000
#: Share of the documents that the query draws.
SHARE = 0.8
FILTER_BITS, FILTER_HASHES = 1 << 26, 4


def features(text: str | None, buckets: int) -> np.ndarray:
    """Bin of each word and each pair of neighbouring words."""
    words = words_of(text)
    hashed = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    pairs = mix(hashed[:-1] * U64(0x9E3779B97F4A7C15) + hashed[1:])
    return (np.concatenate([mix(hashed), pairs]) % U64(buckets)).astype(np.int64)


def filter_places(ids: list[str], size: int) -> np.ndarray:
    """Bits that each id sets, one row for each."""
    seeds = np.array([zlib.crc32(i.encode()) | zlib.adler32(i.encode()) << 32 for i in ids], np.uint64)
    turns = np.arange(1, FILTER_HASHES + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)
    return (mix(seeds[:, None] ^ mix(turns)[None, :]) % U64(size)).astype(np.int64)


def id_filter(ids: DataFrame, size: int) -> np.ndarray:
    """Bloom filter of ``size`` bits over a column of ids as text."""

    def run(batches):
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            at = filter_places(batch.column(0).to_pylist(), size).ravel()
            np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        words = bits.view(np.int64)
        held = np.flatnonzero(words)
        for k in range(0, len(held), 100_000):
            part = held[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part])], ["place", "word"])

    parts = ids.mapInArrow(run, "place bigint, word bigint").groupBy("place").agg(F.bit_or("word").alias("word"))
    words = np.zeros(size // 64, np.int64)
    found = parts.toArrow()
    words[found["place"].to_numpy()] = found["word"].to_numpy()
    return words.view(np.uint8)


def raw_counts(docs: DataFrame, wanted: np.ndarray, buckets: int) -> DataFrame:
    """(id, found, bin, n) from (id, text): counts of each task's bins, and the bins of documents that may be targets."""
    wide = np.uint16 if buckets <= 1 << 16 else np.uint32
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        names, kinds = ["id", "found", "bin", "n"], [pa.string(), pa.binary(), pa.int64(), pa.int64()]
        bits, total = shared.value, np.zeros(buckets, np.int64)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            places = filter_places([i or "" for i in ids], len(bits) * 8)
            may = ((bits[places >> 3] >> (places & 7)) & 1).all(1)
            out: list[tuple] = []
            for i, text, chosen in zip(ids, texts, may.tolist()):
                own = features(text, buckets)
                total += np.bincount(own, minlength=buckets)
                if chosen and i is not None:
                    out.append((i, own.astype(wide).tobytes(), None, None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(held), kinds[0]), pa.nulls(len(held), kinds[1]), pa.array(held), pa.array(total[held])], names
        )

    return docs.mapInArrow(run, "id string, found binary, bin bigint, n bigint")


def bin_counts(docs: DataFrame, target: DataFrame, buckets: int, size: int = FILTER_BITS) -> DataFrame:
    """(bin, raw, target): counts over all of ``docs`` (id, text) and over those whose id is in ``target`` (id)."""
    wide = np.uint16 if buckets <= 1 << 16 else np.uint32
    counted = stored(raw_counts(docs, id_filter(target, size), buckets), "counted")

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer(), wide), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bin", "n"])

    # A join whose strategy does not change with the size of the target.
    chosen = counted.filter("found is not null").select("id", "found").join(target.hint("merge"), "id").select("found")
    each = [
        counted.filter("bin is not null").select("bin", F.col("n").alias("raw"), F.lit(0).cast("bigint").alias("target")),
        chosen.mapInArrow(run, "bin bigint, n bigint").select("bin", F.lit(0).cast("bigint").alias("raw"), F.col("n").alias("target")),
    ]
    return each[0].union(each[1]).groupBy("bin").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_weights(docs: DataFrame, counts: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """(id, n_features, log_weight, sample_key)."""
    raw, target = np.ones(buckets), np.ones(buckets)
    for row in counts.collect():
        raw[row.bin] += row.raw
        target[row.bin] += row.target
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            found = [features(t, buckets) for t in texts]
            weights = [float(ratio[f].sum()) for f in found]
            seeds = np.array([zlib.crc32(f"{i}:{t}".encode()) | zlib.adler32((t or "").encode()) << 32 for i, t in zip(ids, texts)], np.uint64)
            uniform = ((mix(seeds) >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53
            keys = np.array(weights) - np.log(-np.log(uniform))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array(weights, pa.float64()), pa.array(keys)],
                [id_col, "n_features", "log_weight", "sample_key"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_features bigint, log_weight double, sample_key double"
    )


def importance_resample(
    docs: DataFrame, target: DataFrame, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS
) -> DataFrame:
    """id, ``n_features``, ``log_weight``, ``sample_key``, ``kept``; ``target`` holds the ids of target documents."""
    wanted = target.select(F.col(id_col).cast("string").alias("id")).filter("id is not null").distinct()
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    weighed = stored(log_weights(docs, bin_counts(rows, wanted, buckets), id_col, text_col, buckets), "weighed")
    # Copies of one row are told apart by the row they are stored in, so that they are sorted by many tasks.
    told = weighed.withColumn("__row", F.monotonically_increasing_id())
    ranked = numbered(told, [F.desc("sample_key"), F.desc_nulls_last(id_col), "__row"], "__rank")
    kept = F.col("__rank") < round(share * weighed.count())
    return ranked.select(*weighed.columns, kept.alias("kept"))
