"""Language by rank-order profiles of character n-grams (out-of-place distance).

A language's profile is the ranked list of its most frequent n-grams of one to three letters, with word
borders. A text's own list is held against each profile: an n-gram costs the difference of its two ranks,
or the full list length where the profile lacks it. The nearest profile wins.

Learning counts n-grams per Arrow batch, sums the counts in a shuffle with map-side combination and keeps
the top of each language by a windowed limit, which also starts before the shuffle. What is handed to the
tasks is ``TOP`` n-grams for each language in the labels, however many documents there are.

Corner cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if no
document has a label; ties of counts go by n-gram, ties of distance by language name; equal rows get equal
rows; an empty table gives none; other columns are not read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaykit.llm.common import bucket_of, stored

TOP = 400
NO_LANGUAGE = "und"
FOLDS, HELD_OUT = 4, 2
BORDER = 1

_letters: np.ndarray | None = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters[points]


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all n-grams of one to three letters: 21 bits for each character, borders as 1."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = _is_letter(points)
    points[~letter] = BORDER
    pairs = (points[:-1] << 21) | points[1:]
    triples = (pairs[:-1] << 21) | points[2:]
    return np.concatenate([points[letter], pairs[letter[:-1] | letter[1:]], triples[letter[1:-1]]])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, in order, and how often each occurs."""
    codes = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.array([], np.int64)
    return codes[starts], np.diff(np.append(starts, len(codes)))


def top_codes(text: str, top: int) -> np.ndarray:
    """A text's most frequent n-grams, most frequent first."""
    codes, counts = counted(ngram_codes(text))
    return codes[np.argsort(-counts, kind="stable")[:top]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, code, place) of each language's profile; rows without text or label teach nothing."""

    def count(batches):
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            pending = 0
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = ngram_codes(text)
                held.setdefault(lang, []).append(codes)
                pending += len(codes)
                if pending > 4_000_000:  # bounds the memory of a batch of long texts
                    yield from rows_of(held)
                    held, pending = {}, 0
            yield from rows_of(held)

    def rows_of(held):
        for lang, parts in held.items():
            codes, counts = counted(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts.astype(np.int64))],
                ["lang", "code", "n"],
            )

    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    totals = known.mapInArrow(count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return totals.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top).select("lang", "code", "place")


def predict_language(
    docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = TOP, keep=()
) -> DataFrame:
    """``lang_pred`` and ``score`` (one less the mean share of the worst distance) of each row.

    ``keep`` names columns to pass on. ``profiles`` has ``top`` rows for each language and is collected.
    """
    rows = profiles.select("lang", "code", "place").collect()
    langs = sorted({r.lang for r in rows})
    known = np.array(sorted({r.code for r in rows}), np.int64)
    places = np.full((len(known) + 1, len(langs)), -1, np.int64)  # the last row: n-grams no profile has
    for r in rows:
        places[np.searchsorted(known, r.code), langs.index(r.lang)] = r.place - 1

    def predict(text: str | None) -> tuple[str, float]:
        own = top_codes(text, top) if text and langs else ()
        if not len(own):
            return NO_LANGUAGE, 0.0
        at = np.searchsorted(known, own)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
        theirs = places[at]
        cost = np.where(theirs < 0, top, np.abs(theirs - np.arange(len(own))[:, None])).sum(0)
        best = int(cost.argmin())
        return langs[best], 1.0 - float(cost[best]) / (top * len(own))

    schema = docs.select(F.col(id_col), *keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        for batch in batches:
            found = [predict(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                schema.names,
            )

    return docs.select(F.col(text_col).alias("__text_in"), F.col(id_col), *keep).mapInArrow(run, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Profiles from the training folds, predictions for all: id, ``held_out``, ``lang_pred``, ``score``.

    Documents whose CRC-32 of the id modulo 4 is 2 are held out; a null id is never trained on.
    """
    fold = bucket_of(F.col(id_col), FOLDS)
    profiles = learn_profiles(docs.filter(fold != HELD_OUT), text_col, lang_col)
    found = predict_language(docs, profiles, id_col, text_col)
    return found.select(
        id_col, F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def keep_known(docs: DataFrame, least: float, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents with a language and a score of ``least`` or more, in the columns of ``docs``.

    All labelled documents teach, those without id too.
    """
    profiles = stored(learn_profiles(docs, text_col, lang_col), "profiles")
    one = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col).alias("__doc_text"))
    found = predict_language(one, profiles, "__row", "__doc_text")
    good = found.filter((F.col("lang_pred") != NO_LANGUAGE) & (F.col("score") >= least))
    return good.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
