"""Document fingerprints by consistent weighted sampling, and a comparison of neighbours.

A text is a bag of weighted terms: its words with their counts. For each of ``SAMPLES`` hash functions and
each term, two gamma variates and a uniform one, drawn from a hash of the term, place the term's weight on
a random log-scale; the term with the smallest value is the sample, together with the step of the scale its
weight fell on. Two texts agree in a sample with the probability sum(min) / sum(max) of their weights, the
generalised Jaccard similarity. A fingerprint keeps 16 bits of each sample.

Neighbours in the order of ids meet by one shuffle of the texts: the distinct pairs of an id and its text's
hash are range-sorted and so cut into even ranges, each range of texts is sorted in a task, and the first
document of a range is also sent to the range before it. An id that many unlike texts share spans ranges.
Copies of one row follow one another, so all but one of a task's copies have a copy as their next: they are
finished where they lie, and a range gets a text from each task once. Only the last pair of each range
reaches the driver.

Corner cases: a null or empty text has no terms and the empty fingerprint, which is like itself alone;
texts of any length are read whole; rows that share an id follow one another by the hash of their text; a
row with a null id has no next document, and nothing is put in place of what its edit cuts off; the only row
of a table is its own next; ids may be of any type that can be ordered; an empty table gives no rows; other
columns are not read.
"""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import U64, mix, stored, words_of

SAMPLES = 64
RANGE_ROWS = 4000
#: Terms whose variates are held at once.
TERMS, TILE = 32768, 128
GOLDEN = U64(0x9E3779B97F4A7C15)
U32 = np.uint32


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Finaliser of 32-bit hashes, in place."""
    x ^= x >> U32(16)
    x *= U32(0x85EBCA6B)
    x ^= x >> U32(13)
    x *= U32(0xC2B2AE35)
    x ^= x >> U32(16)
    return x


def _uniform(seeds: np.ndarray, number: int) -> np.ndarray:
    drawn = _scrambled(seeds + U32(number * 0x9E3779B9 % 2**32))
    return ((drawn >> U32(9)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-23)


def variates(terms: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r and log(c), from Gamma(2, 1), and beta, uniform, of each term and sample."""
    shape = len(terms), samples
    r, log_c, beta = (np.empty(shape, np.float32) for _ in range(3))
    low, high = terms.astype(np.uint32), (terms >> U64(32)).astype(np.uint32)
    numbers = _scrambled(np.arange(1, samples + 1, dtype=np.uint32) * U32(0x85EBCA77))
    for k in range(0, len(terms), TILE):  # stays in the cache
        own = slice(k, k + TILE)
        seeds = _scrambled(_scrambled(low[own, None] ^ numbers) + high[own, None])
        r[own] = -np.log(_uniform(seeds, 1) * _uniform(seeds, 2))
        log_c[own] = np.log(-np.log(_uniform(seeds, 3) * _uniform(seeds, 4)))
        beta[own] = _uniform(seeds, 5)
    return r, log_c, beta


def fingerprints(texts: list[str | None], samples: int = SAMPLES) -> list[bytes]:
    """Two bytes for each sample; empty for a text without words."""
    out: list[bytes] = []
    bags = [Counter(words_of(t)) for t in texts]
    first = 0
    while first < len(bags):
        places: dict[bytes, int] = {}
        rows: list[list[int]] = []
        for bag in bags[first:]:
            if rows and (len(places) >= TERMS or len(bag) > TERMS):
                break
            rows.append([places.setdefault(word, len(places)) for word in bag])
        chunk = bags[first : first + len(rows)]
        terms = np.fromiter(map(xxhash.xxh3_64_intdigest, places), np.uint64, len(places))
        # A single long text may hold more terms than fit; its terms are then taken in parts.
        if len(chunk) == 1 and len(places) > TERMS:
            out.append(_long(terms, np.fromiter(chunk[0].values(), np.float32, len(terms)), samples))
        else:
            r, log_c, beta = variates(terms, samples)
            ones = _once(r, log_c, beta)
            out += [_sampled(bag, np.array(at, np.int64), terms, r, log_c, beta, ones, samples) for bag, at in zip(chunk, rows)]
        first += len(chunk)
    return out


def _once(r: np.ndarray, log_c: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """The value of a term that occurs once: its step is 0."""
    out = np.empty_like(r)
    for k in range(0, len(r), TILE):
        own = slice(k, k + TILE)
        out[own] = log_c[own] - r[own] * (1 - beta[own])
    return out


def _coded(terms: np.ndarray, steps: np.ndarray) -> bytes:
    return (mix(terms + steps.astype(np.int64).view(np.uint64) * GOLDEN) >> U64(48)).astype("<u2").tobytes()


def _sampled(bag, at, terms, r, log_c, beta, ones, samples) -> bytes:
    if not bag:
        return b""
    weights = np.fromiter(bag.values(), np.float32, len(bag))
    values = ones[at]
    more = np.flatnonzero(weights > 1)
    steps = np.zeros((len(more), samples), np.float32)
    if len(more):
        k = at[more]
        steps = np.floor(np.log(weights[more])[:, None] / r[k] + beta[k])
        values[more] = log_c[k] - r[k] * (steps - beta[k] + 1)
    rows, columns = np.nonzero(values == values.min(0))  # faster than argmin, which takes the first as well
    chosen = np.zeros(samples, np.int64)
    chosen[columns[::-1]] = rows[::-1]
    row = np.full(len(bag), -1)
    row[more] = np.arange(len(more))
    own = row[chosen]
    taken = np.where(own >= 0, steps[own, np.arange(samples)] if len(more) else 0, 0)
    return _coded(terms[at[chosen]], taken)


def _long(terms: np.ndarray, weights: np.ndarray, samples: int) -> bytes:
    best = np.full(samples, np.inf, np.float32)
    won, at = np.zeros(samples, np.uint64), np.zeros(samples, np.float32)
    for k in range(0, len(terms), TERMS):
        part = terms[k : k + TERMS]
        r, log_c, beta = variates(part, samples)
        steps = np.floor(np.log(weights[k : k + TERMS])[:, None] / r + beta)
        values = log_c - r * (steps - beta + 1)
        chosen, column = values.argmin(0), np.arange(samples)
        better = values[chosen, column] < best
        best = np.where(better, values[chosen, column], best)
        won, at = np.where(better, part[chosen], won), np.where(better, steps[chosen, column], at)
    return _coded(won, at)


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal samples; the empty fingerprint is like itself alone."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, ``fingerprint``) of each row, as hexadecimal text."""

    def run(batches):
        for batch in batches:
            found = [f.hex() for f in fingerprints(batch.column(1).to_pylist(), samples)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [id_col, "fingerprint"])

    schema = docs.select(id_col).schema.add("fingerprint", "string")
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _tops(docs: DataFrame, rows: int) -> list[tuple]:
    """The last (id, hash of the text) of each of the even ranges that the distinct ones are cut into, in order."""
    keys = stored(docs.filter("id is not null").select("id", "hash").distinct(), "keys")
    n = max(1, -(-keys.count() // rows))
    ranged = keys.repartitionByRange(n, "id", "hash").select(F.spark_partition_id().alias("range"), "id", "hash")
    tops = ranged.groupBy("range").agg(F.max(F.struct("id", "hash")).alias("top")).select("top.*").collect()
    return sorted(tuple(t) for t in tops)


def _edited(text: str, other: str | None) -> str:
    cut = len(text) // 2
    return text[: len(text) - cut] + (other or "")[:cut]


def _results(pairs: list[tuple], samples: int) -> list[tuple]:
    """What is told of each (text, mark, next text, next mark); the next ones may be None."""
    edited = [_edited(text, other) for text, _, other, _ in pairs]
    return [
        (len(text), hashlib.sha256(new.encode()).hexdigest(), new_mark, likeness(mark, new_mark), 0.0 if far is None else likeness(mark, far))
        for (text, mark, _, far), new, new_mark in zip(pairs, edited, fingerprints(edited, samples))
    ]


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document with its edited text's hash, both fingerprints and their likeness, see the module's text.

    The edit puts the beginning of the next document, in descending order of ids, in place of the last half.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("hash"), "text")
    tops = _tops(rows, range_rows)
    ranges = max(1, len(tops))
    # The order goes down, so a range's first document follows the range above.
    follows = {top: (k + 1) % len(tops) for k, top in enumerate(tops)}
    told = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("edited", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    sent = [("range", pa.int64()), ("part", pa.int32()), ("id", None), ("hash", pa.int64()), ("text", pa.string()), ("mark", pa.binary()), *told]
    unfinished = (None,) * len(told)

    def batch_of(found: list[tuple], columns: list[tuple], id_type) -> pa.RecordBatch:
        values = list(zip(*found)) or [()] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(v, t or id_type) for v, (_, t) in zip(values, columns)], [name for name, _ in columns])

    def send(batches):
        marks: dict[tuple, bytes] = {}
        copies: dict[tuple, list] = {}
        for batch in batches:
            ids, hashes, texts = (c.to_pylist() for c in batch.columns)
            own = list(zip(ids, hashes))
            new = {key: text for key, text in zip(own, texts) if key not in marks}
            marks.update(zip(new, fingerprints(list(new.values()), samples)))
            out = []
            for key, text in zip(own, texts):
                doc, code = key
                alone = doc is None
                if not alone and new.pop(key, None) is not None:
                    place = bisect_left(tops, key)
                    out.append((place, 1, doc, code, text, marks[key], *unfinished))
                    if key in follows:
                        out.append((follows[key], 2, doc, code, text, marks[key], *unfinished))
                    continue
                # The copy before is this one's next, whichever of the copies that is: nothing is left to wait for.
                if key not in copies:
                    result = _results([(text, marks[key], *((None, None) if alone else (text, marks[key])))], samples)[0]
                    copies[key] = [0, result]
                copies[key][0] += 1
                out.append(((code + copies[key][0]) % ranges, 0, doc, code, None, marks[key], *copies[key][1]))
            yield batch_of(out, sent, batch.column(0).type)

    def edit(batches):
        waiting: tuple | None = None
        for batch in batches:
            id_type = batch.column(2).type
            whole, pairs = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1] == 0:
                    whole.append((row[2], row[5], *row[6:]))
                    continue
                if waiting is not None:
                    pairs.append((waiting, row if row[0] == waiting[0] else None))
                waiting = row if row[1] == 1 else None
            yield finished(whole, pairs, id_type)
        if waiting is not None:
            yield finished([], [(waiting, None)], id_type)

    def finished(whole, pairs, id_type):
        results = _results([(row[4], row[5], *((None, None) if other is None else other[4:6])) for row, other in pairs], samples)
        whole += [(row[2], row[5], *result) for (row, _), result in zip(pairs, results)]
        shown = [(doc, n, sha, mark.hex(), new.hex(), near, far) for doc, mark, n, sha, new, near, far in whole]
        return batch_of(shown, shown_columns, id_type)

    shown_columns = [
        ("doc_id", None), told[0], told[1], ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), told[3], told[4]
    ]
    dealt = rows.mapInArrow(
        send,
        f"range bigint, part int, id {kind}, hash bigint, text string, mark binary,"
        " n_chars bigint, edited_sha256 string, edited binary, near_edited double, near_next double",
    )
    placed = dealt.repartition(ranges, "range").sortWithinPartitions("range", "part", F.desc("id"), F.desc("hash"))
    return placed.mapInArrow(
        edit,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    ).withColumnRenamed("doc_id", id_col)
