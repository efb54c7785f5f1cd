r"""Number of tokens of each document, for budgets and limits, without its ids.

Arrow batches go to the tokenizer in batches of about ``BATCH_BYTES`` of text, whatever the number of documents,
and only lengths come back. Where the vocabulary file splits texts into words and drops the white space, as
``drops_space`` finds out from its settings, every run of ASCII white space is a safe boundary: normalisation
joins no character to white space, no word, special string or merge reaches over it, so the number of tokens is
the sum over the parts. Texts are then cut there, long ones into pieces of ``PIECE_BYTES`` first, and a part
that a task has met lately is not encoded again. Other vocabularies get whole texts.

A task holds one Arrow batch, one piece's words and ``REMEMBERED`` lengths at most.

Corner cases: a null or empty text has no bytes and no tokens; a text without white space, however long, is one
part; equal rows are counted once each; a null id stays null; bytes that are no UTF-8 count as U+FFFD; an empty
table gives no rows; other columns are not read.
"""

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 256 * 1024
PIECE_BYTES = 1024 * 1024
REMEMBERED = 300_000
LIMIT = 2048
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Fixed value: the words of a vocabulary file that drops white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def drops_space(spec: dict) -> bool:
    """Whether white space only separates words under these settings of the ``tokenizers`` library."""
    before = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    for step in before.get("normalizers", [before]):
        spaces = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if step["type"] not in ("NFC", "Lowercase") and not spaces:
            return False
    split = spec.get("pre_tokenizer") or {}
    first = (split.get("pretokenizers") or [split])[0]
    wanted = {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
    whole = not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in spec.get("added_tokens", []))
    return whole and not spec.get("post_processor") and {k: first.get(k) for k in wanted} == wanted


class Counter:
    """Token counts by a ``.json`` file of ``tokenizers`` or a ``.model`` file of ``sentencepiece``."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.by_word = False
            self.encoded = lambda texts: map(len, model.encode(texts, num_threads=1))
        else:
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as file:
                self.by_word = drops_space(json.load(file))
            # The task's core is the only one it has.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encoded = lambda texts: map(len, model.encode_batch_fast(texts, add_special_tokens=False))
        self.known: dict[bytes, int] = {}

    def lengths(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text, encoded in batches of about ``BATCH_BYTES``."""
        out: list[int] = []
        batch: list[str] = []
        held = 0
        for text in texts:
            batch.append(text.decode("utf-8", "replace"))
            held += len(text)
            if held >= BATCH_BYTES:
                out += self.encoded(batch)
                batch, held = [], 0
        return out + list(self.encoded(batch)) if batch else out

    def count(self, texts: list[bytes]) -> list[int]:
        if not self.by_word:
            return self.lengths(texts)
        totals = [0] * len(texts)
        waiting: list[tuple[int, list[bytes]]] = []
        held = 0
        for k, text in enumerate(texts):
            for piece in pieces(text):
                waiting.append((k, piece.split()))
                held += len(piece)
                if held >= PIECE_BYTES:
                    self.add(waiting, totals)
                    waiting, held = [], 0
        self.add(waiting, totals)
        return totals

    def add(self, waiting: list[tuple[int, list[bytes]]], totals: list[int]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*(words for _, words in waiting)) - self.known.keys())
        self.known.update(zip(new, self.lengths(new)))
        for k, words in waiting:
            totals[k] += sum(map(self.known.__getitem__, words))


def pieces(text: bytes, size: int = PIECE_BYTES):
    """``text`` in parts of about ``size`` bytes, cut at white space."""
    at = 0
    while len(text) - at > size:
        cut = SPACE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per worker."""
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, ``n_bytes``, ``n_tokens``, ``over_limit`` of each document; ``path`` is a file that every executor has."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_bytes", "n_tokens", "over_limit"]

    def run(batches):
        tokens = counter(path)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            counts = tokens.count(texts)
            sizes = pa.array([len(t) for t in texts], pa.int64())
            over = pa.array([n > limit for n in counts], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts, pa.int64()), over], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
