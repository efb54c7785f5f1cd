"""Sequences of tokens, packed along a space-filling curve.

A document's token ids are projected by hashed signs to a few dimensions and its point to a key on the
Hilbert curve. Documents are range-sorted by key, so that neighbours along the curve, which are alike, meet
in the same task, and each task lays its documents end to end into sequences of ``SEQUENCE`` tokens. What
is left at the end of a task is cut into powers of two, which need no padding.

Token ids are worked out once and stored, as the range sort reads its input twice. Ties of the key are
broken by document and input row, so that a hot key, such as that of many copies, is cut over many tasks.
A task holds one Arrow batch and one unfinished sequence.

Corner cases: a null or empty text is the end id alone; texts of any length are cut freely; equal rows are
packed once each; an empty table gives no rows; a null id stays null; other columns are not read.
"""

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import U64, mix, stored

SEQUENCE = 2048
END = 1
DIMENSIONS, BITS = 4, 15
#: Tokens that one packing task should hold.
TASK_TOKENS = 4_000_000

SCHEMA = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def byte_values() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """Ids as the ``tokenizers`` library gives them for a byte-level vocabulary file without merges across words.

    ``tiktoken`` finds the same ids in a fifth of the time, as ids are merge ranks. Texts with the name of a
    special token go through ``tokenizers`` itself. The pattern's rule for runs of white space needs a look
    ahead, which is slow, so only texts with such a run pay for it.
    """

    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        values = byte_values()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(values[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        make = lambda name, end: tiktoken.Encoding(name, pat_str=self.WORDS + end, mergeable_ranks=ranks, special_tokens={})
        self.quick, self.exact = make("quick", r"|\s+"), make("exact", r"|\s+(?!\S)|\s+")
        self.run = re.compile(r"\s\s")
        self.special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        self.size = self.full.get_vocab_size()

    def ids(self, text: str) -> list[int]:
        if self.special and self.special.search(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return (self.exact if self.run.search(text) else self.quick).encode_ordinary(text)


_loaded: dict[str, ByteTokenizer] = {}


def tokenizer(path: str) -> ByteTokenizer:
    """One per worker."""
    if path not in _loaded:
        _loaded[path] = ByteTokenizer(path)
    return _loaded[path]


def sign_table(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A hashed sign for each id and dimension."""
    ids = np.arange(size, dtype=np.uint64)[:, None] * U64(dimensions) + np.arange(dimensions, dtype=np.uint64)
    return np.where(mix(ids + U64(0x9E3779B97F4A7C15)) >> U64(63), 1.0, -1.0).astype(np.float32)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of each row of ``cells`` (integers below 2**bits).

    From the top bit down, the cell's orthant is undone by a reflection or an exchange of axes; the Gray
    code of what remains, bit by bit over all axes, is the position.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            set_bit = (x[i] & q) != 0
            swap = np.where(set_bit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_bit, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def token_rows(docs: DataFrame, path: str, id_col: str, text_col: str, end: int = END) -> DataFrame:
    """(doc_id, key, row, n_tokens, ids): the ids packed into two bytes each, or four for large vocabularies."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        tok = tokenizer(path)
        signs = sign_table(tok.size)
        dtype = np.dtype("<u2" if tok.size <= 1 << 16 else "<u4")
        for batch in batches:
            ids, points = [], np.zeros((batch.num_rows, DIMENSIONS))
            for k, text in enumerate(batch.column(1).to_pylist()):
                own = np.array([*tok.ids(text), end] if text else [end], dtype)
                points[k] = signs[own].sum(0) / np.sqrt(len(own))
                ids.append(own)
            cells = np.clip((0.5 + 0.5 * np.tanh(points / 4)) * (1 << BITS), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(hilbert_keys(cells)),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                ],
                ["doc_id", "key", "n_tokens", "ids"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, key bigint, n_tokens bigint, ids binary").withColumn(
        "row", F.monotonically_increasing_id()
    )


def lay_out(pending: list[tuple], lengths: list[int], first: int) -> list[tuple]:
    """Pieces of ``pending`` = (doc_id, start, ids, doc_tokens), cut into sequences of the given lengths."""
    out, at, offset = [], 0, 0
    for doc, start, ids, total in pending:
        done = 0
        while done < len(ids):
            take = min(len(ids) - done, lengths[at] - offset)
            crc = zlib.crc32(ids[done : done + take].astype("<u4").tobytes())
            out.append((doc, start + done, take, crc, total, first + at, offset))
            done += take
            offset += take
            if offset == lengths[at]:
                at, offset = at + 1, 0
    return out


def pack_rows(sorted_rows: DataFrame, dtype: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of each partition's documents, in their order."""
    kind = sorted_rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        made = TaskContext.get().partitionId() << 32
        pending: list[tuple] = []
        held, types = 0, None

        def batch_of(pieces):
            columns = list(zip(*pieces))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            types = [batch.column(0).type, *[pa.int64()] * 6]
            pieces: list[tuple] = []
            for doc, total, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids, start = np.frombuffer(data, dtype), 0
                while held + len(ids) - start >= sequence:
                    cut = start + sequence - held
                    pieces += lay_out([*pending, (doc, start, ids[start:cut], total)], [sequence], made)
                    pending, held, start, made = [], 0, cut, made + 1
                if start < len(ids):
                    pending.append((doc, start, ids[start:], total))
                    held += len(ids) - start
            if pieces:
                yield batch_of(pieces)
        if pending:
            lengths = [1 << b for b in range(held.bit_length() - 1, -1, -1) if held >> b & 1]
            yield batch_of(lay_out(pending, lengths, made))

    return sorted_rows.select("doc_id", "n_tokens", "ids").mapInArrow(run, SCHEMA.format(id=kind))


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", task_tokens: int = TASK_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``path`` is a byte-level vocabulary file of the ``tokenizers`` library, readable on every executor.
    """
    tokens = stored(token_rows(docs, path, id_col, text_col), "tokens")
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    dtype = "<u2" if tokenizer(path).size <= 1 << 16 else "<u4"
    order = ["key", "doc_id", "row"]
    placed = tokens.repartitionByRange(max(1, -(-total // task_tokens)), *order).sortWithinPartitions(*order)
    return pack_rows(placed, dtype)
