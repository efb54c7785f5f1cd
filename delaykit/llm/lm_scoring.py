"""Document scores by prediction by partial matching over bytes, and by a unigram base.

The model is a trie of byte contexts up to ``ORDER`` bytes, held as counts of (context, byte). A byte that
did not follow its context is reached by an escape to the next shorter one (the number of distinct bytes
seen is the escape's count), where the bytes already ruled out are excluded from the counts. As a context's
bytes are also bytes of its suffix, the excluded mass is one sum per context, so that every probability
comes from joins and sums over the counts; no task ever holds the whole trie.

Each task cuts the documents it reads into blocks of about ``BLOCK_BYTES`` of text, so that no key, and no
number of copies, makes a block larger. A block gives its own distinct n-grams and words with their training
counts, and its texts, compressed; the counts are summed over all blocks and the results sent back to the
blocks that asked, where they meet the texts. What moves is the vocabulary of each block, which grows with the
input, and the texts once.

A text is scored as its words in order, A-Z lower-cased, joined by single spaces and followed by an end
byte, so that both scores are of the same tokens.

Corner cases: a null or empty text is the end alone; a null id is never trained on; texts of any length are
scored to their end; equal rows are scored once each; without training documents all counts are 0; an empty
table gives no rows; other columns are not read.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import bucket_of, stored, words_of

ORDER = 4
BLOCK_BYTES = 32 * 1024**2
#: Of the tables of counts, which are long and written once.
CODEC = "zstd"
FOLDS, HELD_OUT = 10, 0
#: Bytes that UTF-8 never uses: before the beginning, and after the end of a text.
START, END = 0xFE, 0xFF
#: Token that stands for the end in the word counts; no word is empty.
END_TOKEN = b""
PART = 1_000_000


def text_bytes(words: list[bytes], order: int) -> np.ndarray:
    return np.frombuffer(bytes([START]) * order + b" ".join(words) + bytes([END]), np.uint8).astype(np.int64)


def gram_codes(words: list[bytes], order: int) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, as one number."""
    data = text_bytes(words, order)
    n = len(data) - order
    codes = data[:n].copy()
    for k in range(1, order + 1):
        codes = (codes << 8) | data[k : k + n]
    return codes


def block_terms(docs: DataFrame, order: int, block_bytes: int) -> DataFrame:
    """(block, word, gram, n, docs): the distinct words and n-grams of each block, and its documents as one value.

    ``docs`` has (id, text, train, held_out); n counts training documents.
    """

    def run(batches):
        first, made = TaskContext.get().partitionId() << 32, 0
        parts: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            start = 0
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for k, size in enumerate(sizes.tolist()):
                held += size
                if held >= block_bytes:
                    yield from block_rows(first + made, [*parts, batch.slice(start, k + 1 - start)])
                    parts, held, start, made = [], 0, k + 1, made + 1
            if start < batch.num_rows:
                parts.append(batch.slice(start))
        if parts:
            yield from block_rows(first + made, parts)

    def block_rows(block: int, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts)
        words: Counter = Counter()
        seen: set[bytes] = set()
        grams: list[tuple[np.ndarray, np.ndarray]] = []
        held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        pending = 0

        def fold():
            for train, codes in held.items():
                if codes:
                    found, counts = np.unique(np.concatenate(codes), return_counts=True)
                    grams.append((found, counts if train else np.zeros_like(counts)))
                    codes.clear()
            if sum(len(found) for found, _ in grams) > 2 * PART:
                merge()

        def merge():
            if grams:
                found, at = np.unique(np.concatenate([g[0] for g in grams]), return_inverse=True)
                sums = np.bincount(at, np.concatenate([g[1] for g in grams]).astype(np.float64)).astype(np.int64)
                grams[:] = [(found, sums)]

        for text, train in zip(table["text"].to_pylist(), table["train"].to_pylist()):
            own = words_of(text)
            if train:
                words.update(own)
                words[END_TOKEN] += 1
            else:
                seen.update(own)
                seen.add(END_TOKEN)
            codes = gram_codes(own, order)
            held[train].append(codes)
            pending += len(codes)
            if pending > PART:
                fold()
                pending = 0
        fold()
        merge()
        codes, sums = grams[0]
        listed = [*words, *(seen - words.keys())]
        yield batch_of(block, word=listed, n=[words.get(w, 0) for w in listed])
        for k in range(0, len(codes), PART):
            yield batch_of(block, gram=codes[k : k + PART], n=sums[k : k + PART])
        yield batch_of(block, docs=[packed(table.select(["id", "text", "held_out"]))])

    def batch_of(block: int, **given) -> pa.RecordBatch:
        size = len(next(iter(given.values())))
        kinds = {"word": pa.binary(), "gram": pa.int64(), "n": pa.int64(), "docs": pa.binary()}
        columns = {"block": pa.array([block] * size, pa.int64())}
        for name, kind in kinds.items():
            columns[name] = pa.array(given[name], kind) if name in given else pa.nulls(size, kind)
        return pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, "block bigint, word binary, gram bigint, n bigint, docs binary")


def packed(table: pa.Table) -> bytes:
    """A table as compressed bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpacked(data) -> pa.Table:
    return pa.ipc.open_stream(data.as_buffer()).read_all()


def ppm_log10(grams: DataFrame, order: int) -> DataFrame:
    """(gram, value): log10 probability of the last byte of each gram after its context.

    ``grams`` has (gram, n) for every gram to be scored, n being 0 where training did not see it. It is read
    several times, so it should be stored.
    """
    counts = [None] * (order + 1)
    counts[order] = grams.filter("n > 0")
    for k in range(order - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        counts[k] = stored(counts[k + 1].groupBy(shorter.alias("gram")).agg(F.sum("n").alias("n")), "grams", CODEC)
    rows = grams.select("gram", F.lit(0.0).alias("value"), F.lit(False).alias("found"), F.lit(0).cast("bigint").alias("mass"), F.lit(0).cast("bigint").alias("kinds"))
    for k in range(order, -1, -1):
        # Of each context: its count, its distinct bytes, and the count of these bytes one context shorter.
        own = counts[k].withColumn("context", F.shiftright("gram", 8))
        if k:
            below = counts[k - 1].select(F.col("gram").alias("short"), F.col("n").alias("n_below"))
            own = own.join(below, F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)) == F.col("short"))
        else:
            own = own.withColumn("n_below", F.lit(0).cast("bigint"))
        contexts = own.groupBy("context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("n_below").alias("next_mass")
        )
        mask = F.lit((1 << 8 * (k + 1)) - 1)
        rows = (
            rows.withColumn("own", F.col("gram").bitwiseAND(mask))
            .withColumn("in", F.shiftright("own", 8))
            .join(contexts, F.col("in") == F.col("context"), "left")
            .join(counts[k].select(F.col("gram").alias("at"), "n"), F.col("own") == F.col("at"), "left")
        )
        left, novel = F.col("total") - F.col("mass"), F.col("distinct") - F.col("kinds")
        step = (
            F.when(F.col("found") | F.col("context").isNull(), 0.0)
            .when(F.col("n").isNotNull(), F.log10(F.col("n") / (left + novel)))
            .when(novel > 0, F.log10(novel / (left + novel)))
            .otherwise(0.0)
        )
        known = F.col("context").isNotNull()
        rows = rows.select(
            "gram",
            (F.col("value") + step).alias("value"),
            (F.col("found") | F.col("n").isNotNull()).alias("found"),
            F.when(known, F.col("next_mass")).otherwise(0).alias("mass"),
            F.when(known, F.col("distinct")).otherwise(0).alias("kinds"),
        )
    # Bytes never seen at all share what is left of the alphabet.
    last = F.when(F.col("found"), 0.0).otherwise(-F.log10(F.lit(256) - F.col("kinds")))
    return rows.select("gram", (F.col("value") + last).alias("value"))


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``n_bytes``.

    Training documents are those whose CRC-32 of the id modulo 10 is not 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fold = bucket_of(F.col(id_col), FOLDS)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(fold != HELD_OUT, F.lit(False)).alias("train"),
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
    )
    terms = stored(block_terms(rows, order, block_bytes), "terms", CODEC)
    words = terms.filter("word is not null").select("block", "word", "n")
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "words", CODEC)
    total, distinct = counts.filter("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    grams = terms.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
    values = stored(ppm_log10(stored(grams, "grams", CODEC), order), "values", CODEC)
    answers = (
        words.select("block", "word")
        .join(counts, "word")
        .select("block", "word", F.lit(None).cast("bigint").alias("gram"), F.col("n").cast("double").alias("value"))
        .union(
            terms.filter("gram is not null").select("block", "gram").join(values, "gram")
            .select("block", F.lit(None).cast("binary").alias("word"), "gram", "value")
        )
    )
    divisor = total + 0.1 * (distinct + 1)

    def run(blocks: pa.Table, right: pa.Table) -> pa.Table:
        left = pa.concat_tables([unpacked(data) for data in blocks["docs"]])
        is_word = right["word"].is_valid()
        chosen = right.filter(is_word)
        base = {
            w: (n > 0, math.log10((n + 0.1) / divisor)) for w, n in zip(chosen["word"].to_pylist(), chosen["value"].to_pylist())
        }
        model = right.filter(right["gram"].is_valid())
        codes, logs = model["gram"].to_numpy(), model["value"].to_numpy()
        by = np.argsort(codes)
        codes, logs = codes[by], logs[by]
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
        for text in left["text"].to_pylist():
            own = words_of(text)
            found = [(n, *base[w]) for w, n in Counter(own).items()] + [(1, *base[END_TOKEN])]
            grams, times = np.unique(gram_codes(own, order), return_counts=True)
            out["n_tokens"].append(len(own) + 1)
            out["n_known"].append(sum(n for n, known, _ in found if known))
            out["base_score"].append(math.fsum(n * log for n, _, log in found))
            out["score"].append(float((logs[np.searchsorted(codes, grams)] * times).sum()))
            out["n_bytes"].append(int(times.sum()))
        return pa.table({
            "id": left["id"], "held_out": left["held_out"], "n_tokens": pa.array(out["n_tokens"], pa.int64()),
            "n_known": pa.array(out["n_known"], pa.int64()), "train_tokens": pa.array([total] * len(left), pa.int64()),
            "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64()),
            "n_bytes": pa.array(out["n_bytes"], pa.int64()),
        })

    blocks = terms.filter("docs is not null").select(F.col("block").alias("place"), "docs")
    scored = (
        blocks.groupBy("place").cogroup(answers.groupBy("block")).applyInArrow(
            run,
            f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double,"
            " score double, n_bytes bigint",
        )
    )
    return scored.withColumnRenamed("id", id_col)
