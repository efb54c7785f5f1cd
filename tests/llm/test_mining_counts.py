"""Hard negatives, source divergence and token counts against brute force and in corner cases."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from delaykit.llm import common, hard_negatives, source_divergence, token_counts
from delaykit.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.test_operators import ODD, odd

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# --- hard negatives --------------------------------------------------------


def brute_negatives(rows, is_anchor):
    """Every anchor against every row, by definition."""
    whole = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) or abs(256 * x) >= 1 << 27 for x in vector):
            continue
        whole.append((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    last = lambda x: (x is None, x or 0)
    out = []
    for a_id, a_label, a in {w for w in whole if w[0] is not None and is_anchor(w[0])}:
        scored = sorted(
            ((sum(x * y for x, y in zip(a, b)), b_id, b_label) for b_id, b_label, b in whole if b_id != a_id),
            key=lambda s: (-s[0], last(s[1])),
        )
        for p_score, p_id, _ in [s for s in scored if s[2] == a_label][:5]:
            fit = [s for s in scored if s[2] != a_label and 80 * p_score <= 100 * s[0] <= 100 * p_score][:5]
            out += [(a_id, p_id, k, n_id, p_score, n_score) for k, (n_score, n_id, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
VECTORS = "vec_id bigint, embedding array<float>, label int"


def mined(df, every=10, **sizes):
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, **sizes)
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def clustered(n, seed, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [
        (i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(size=dims) * 0.2], int(rng.integers(3)))
        for i in range(n)
    ]


@pytest.mark.parametrize("sizes", [{}, {"block_anchors": 7, "chunk_rows": 60}])
def test_negatives_equal_brute_force(spark, sizes):
    rows = clustered(400, 3)
    wanted = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(wanted) > 300 and mined(spark.createDataFrame(rows, VECTORS), **sizes) == wanted


def test_negatives_of_odd_rows(spark):
    rows = clustered(60, 4)
    hot = [0.5, -0.25, 0.125, 1.0, 0.0, 2.0]
    rows += [(100 + i, hot, i % 2) for i in range(150)]  # one vector with most rows, ties by id
    rows += [(300, hot, 1), (300, hot, 1), (300, hot[::-1], 0)]  # an anchor twice over, and another one of its id
    rows += [(301, None, 1), (302, hot, None), (303, [0.1, None] * 3, 1), (304, [float("nan")] * 6, 1), (305, [float("inf")] + hot[1:], 1)]
    rows += [(306, [], 1), (310, [0.5], 0), (307, hot + [9.0], 1), (None, hot, 1), (None, hot, 0), (308, [1e30] * 6, 1)]
    df = spark.createDataFrame(rows, VECTORS)
    # Columns whose names the operator uses itself change nothing.
    for name in ("id", "v", "row", "block", "chunk", "anchor", "score"):
        df = df.withColumn(name, F.lit("x"))
    wanted = brute_negatives(rows, lambda i: i % 10 == 0)
    assert wanted and mined(df, block_anchors=5, chunk_rows=40) == wanted
    assert mined(df.filter("false")) == [] and mined(df.filter("vec_id = 301")) == [] and mined(df.filter("vec_id = 310")) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [4e5 + i, -3e5 + 7 * i, 1.5 * i], i % 2) for i in range(40)]
    assert mined(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_tree_is_minimal_and_bounds_hold():
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(size=(60, 8)) * 256)
    tree = hard_negatives.spanning_tree(vectors)
    assert sorted(t[0] for t in tree) == list(range(60)) and all(parent < place for place, (_, parent, _) in enumerate(tree))
    far = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    assert all(abs(far[row, tree[parent][0]] - edge) < 1e-6 for row, parent, edge in tree[1:])
    edges = sorted((far[i, j], i, j) for i in range(60) for j in range(i))
    group, total = list(range(60)), 0.0
    for length, i, j in edges:
        if group[i] != group[j]:
            total, old = total + length, group[i]
            group = [group[j] if g == old else g for g in group]
    assert abs(total - sum(t[2] for t in tree)) < 1e-6
    x = np.floor(rng.normal(size=(500, 8)) * 256)
    scores = vectors @ x.T
    for row, parent, edge in tree[1:]:
        assert (np.abs(scores[row] - scores[tree[parent][0]]) <= edge * np.sqrt((x**2).sum(1)) + 1e-6).all()


# --- source divergence -----------------------------------------------------


def brute_divergence(rows):
    docs = collections.defaultdict(lambda: collections.defaultdict(int))
    counts = collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(found)
        for term in set(found):
            docs[lang][term] += 1
    out = []
    for lang in {g[0] for g in counts}:
        kept = {t for t, n in docs[lang].items() if n >= 3}
        shares = {}
        sources = [s for la, s in counts if la == lang]
        whole = sum((counts[lang, s] for s in sources), collections.Counter())
        for name, own in [(None, whole), *((s, counts[lang, s]) for s in sources)]:
            total = sum(own[t] for t in kept)
            shares[name] = {t: 1 + 1_000_000_000 * (own[t] + 1) // (total + len(kept)) for t in kept}
        for s in sources:
            p, q = shares[s], shares[None]
            pairs = [(o, sum((p[t] - shares[o][t]) ** 2 // shares[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


SIZES = [{}, {"block_terms": 3, "block_groups": 2}]
DOCS = "doc_id bigint, text string, lang string, source string, term string, n int, side int"


def diverged(df, **sizes):
    return sorted(tuple(r) for r in source_divergence.source_divergence(df, **sizes).collect())


@pytest.mark.parametrize("sizes", SIZES)
def test_divergence_equals_brute_force(spark, sizes):
    rng = random.Random(8)
    words = ["Zu", "zu", "é", "É", "über", "x1y", "a_b", "漢字", "don't", "K", "ſ", *(f"w{chr(97 + k)}" for k in range(20))]
    rows = []
    for i in range(160):
        lang, source = rng.choice(["en", "en", "en", "de", None, "fr"]), rng.choice(["s0", "s0", "s0", "s1", "s2", "é", None])
        text = " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randrange(30)))
        rows.append((i, rng.choice([text, text, text.upper(), None]), lang, source, "t", 1, 2))
    rows += [(900, "alone", "xx", "s1", "t", 1, 2), (901, None, "yy", "s1", "", 0, 0), (902, "", "yy", "s2", None, None, None)]
    rows += [rows[3]] * 4 + [(903, "lang " * 30000, "en", "s9", "t", 1, 2)]
    wanted = brute_divergence([(r[2], r[3], r[1]) for r in rows])
    assert {w[0] for w in wanted} == {"en", "de", "", "fr", "yy"}
    assert diverged(spark.createDataFrame(rows, DOCS), **sizes) == wanted


def test_divergence_of_odd_rows(spark):
    assert diverged(odd(spark)) == brute_divergence([(r[2], r[3], r[1]) for r in ODD])
    assert diverged(odd(spark).filter("false")) == [] and diverged(odd(spark).filter("text is null")) == []


def test_shares_of_counts_beyond_a_long(spark):
    n, whole = 4 * 10**15, 7 * 10**16 + 3
    df = spark.createDataFrame([(n, whole)], "n bigint, whole bigint")
    assert df.select(source_divergence.share(F.col("n"), F.col("whole"))).first()[0] == 1 + 10**9 * (n + 1) // whole


def test_level_products_do_not_depend_on_their_parts(monkeypatch):
    rng = np.random.default_rng(2)
    levels = 1 + rng.poisson(3, (200, 6)).astype(np.int64) ** 3
    left, right = np.array([0, 2, 5]), np.array([1, 3])
    apart = levels[:, left][:, :, None] - levels[:, right][:, None, :]
    wanted = (apart * apart // levels[:, right][:, None, :]).sum(0)
    for columns in (6, 40, 10_000):
        monkeypatch.setattr(source_divergence, "COLUMNS", columns)
        assert (source_divergence.level_products(levels, left, right) == wanted).all()


# --- token counts ----------------------------------------------------------


def library_count(path):
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("path", [WORDS, BYTES, PIECES])
def test_token_counts_equal_the_library(spark, path):
    docs = common.table(spark, SMALL, "documents").select("doc_id", "text", F.lit("x").alias("n_tokens"))
    count = library_count(path)
    found = {r.doc_id: tuple(r)[1:] for r in token_counts.token_counts(docs, path).collect()}
    for row in docs.collect():
        n = count(row.text or "")
        assert found[row.doc_id] == (len((row.text or "").encode()), n, n > 2048)


def test_counts_of_odd_texts():
    count, counter = library_count(WORDS), token_counts.Counter(WORDS)
    assert counter.by_word and not token_counts.Counter(BYTES).by_word
    texts = [
        "", " \t\n", "<|endoftext|>", "a<|startoftext|>b <|endof text|>", "it's I'LL they 've", "é ́e İ ΑΣ ς ﬁ",
        "a b c\u0085d\x1ce\x1ff\x0bg\x0ch", "漢字 かな 12 34", "x" * 5000, "\U0001f600 \U0001f468‍\U0001f469", "a b", "﻿z",
    ]
    rng = random.Random(4)
    texts += ["".join(rng.choices("aZ '1́é \t\n.<|é漢​ß", k=rng.randrange(60))) for _ in range(400)]
    encoded = [t.encode() for t in texts]
    assert counter.count(encoded) == [count(t) for t in texts]
    long = " ".join(texts * 3)
    assert counter.count([long.encode()]) == [count(long)]


def test_pieces_keep_every_byte(monkeypatch):
    text = ("wort " * 50 + "x" * 400 + "\n") * 9
    parts = list(token_counts.pieces(text.encode(), 64))
    assert b"".join(parts) == text.encode() and len(parts) > 20
    monkeypatch.setattr(token_counts, "PIECE_BYTES", 64)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 50)
    monkeypatch.setattr(token_counts, "REMEMBERED", 1)
    assert token_counts.Counter(WORDS).count([text.encode(), b"a b"]) == [library_count(WORDS)(text), 2]


def test_token_counts_of_odd_rows(spark):
    found = token_counts.token_counts(odd(spark), WORDS)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = sorted(tuple(r)[1:] for r in found.collect())
    count = library_count(WORDS)
    assert rows == sorted((len((r[1] or "").encode()), count(r[1] or ""), count(r[1] or "") > 2048) for r in ODD)
    assert token_counts.token_counts(odd(spark).filter("false"), WORDS).count() == 0


def test_queries_read_whole_tables(spark):
    assert QUERIES["op13_token_counts"](spark, SMALL).count() == common.table(spark, SMALL, "documents").count()
