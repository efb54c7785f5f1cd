"""Operators against brute force, in corner cases, and on planted groups."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from delaykit.llm import chat_quotes, common, fingerprints, importance, language_id, lm_scoring, near_dedup, packing, quality_rules
from delaykit.llm import sentence_pieces, warc
from delaykit.llm.components import connected_components
from tests.conftest import SMALL

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, n_words string"
LONG = " ".join(f"wort{k % 977}" for k in range(30000))
ODD = [
    (1, None, None, None, None, 5, "x"),
    (2, "", "en", None, 0, None, None),
    (3, " \n\t ", None, "s", 4, 1, "y"),
    (4, "one two", "en", "s", 7, 1, "y"),
    (5, "the quick fox is in the old town and it sleeps all day long.", "en", "s", 60, 1, "y"),
    (6, "the quick fox is in the old town and it sleeps all day long.", None, "s", 60, 1, "y"),
    (7, LONG, "de", "s", len(LONG), 1, "y"),
    (7, LONG, "de", "s", len(LONG), 1, "y"),
    (None, "a lonely text without any number at all, is it not so?", "en", "s", 54, 1, "y"),
    (9, "12 34 !!", "en", "s", 8, 1, "y"),
    (10, "der die das <|endoftext|> und  \n\n  Ende▁x.", "de", "s", 30, 1, "y"),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def documents(spark):
    return common.table(spark, SMALL, "documents")


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


OPERATORS = {
    "quality": quality_rules.quality_rules,
    "fingerprints": fingerprints.compare_neighbours,
    "plain_fingerprints": fingerprints.fingerprint_documents,
    "scores": lm_scoring.score_documents,
    "pieces": lambda d: sentence_pieces.encode(d, PIECES),
    "piece_digests": lambda d: sentence_pieces.encode_digests(d, PIECES),
    "importance": lambda d: importance.importance_resample(d, d.select("doc_id").limit(2)),
    "language": language_id.language_id,
    "near": near_dedup.near_duplicates,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    assert OPERATORS[name](odd(spark)).count() == len(ODD)
    assert OPERATORS[name](odd(spark).filter("false")).count() == 0
    assert OPERATORS[name](odd(spark).filter("text is null")).count() == 1


def test_filters_keep_columns_on_odd_rows(spark):
    for keep in (quality_rules.keep_good, near_dedup.keep_one, lambda d: language_id.keep_known(d, 0.2)):
        kept = keep(odd(spark))
        assert kept.columns == odd(spark).columns and kept.count() <= len(ODD)
        assert keep(odd(spark).filter("false")).count() == 0
    assert near_dedup.keep_one(odd(spark)).filter("doc_id in (5, 6)").count() == 1


# --- quality rules ---------------------------------------------------------


def test_line_rules(spark):
    good = "This is a plain sentence with enough words to stay in."
    bad = ["Home", "a | b | c | d.", "%%% x &&& y.", "NOW!! BUY!! THIS!!", "no mark at the end", "All rights reserved.", "THREE BIG WORDS."]
    text = "\n".join([good, *bad, good, "", good])
    row = quality_rules.quality_rules(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert [x.line for x in row.removed] == bad and row.cleaned_text == "\n".join([good, good, "", good])
    assert row.n_dup_lines == 2 and row.n_repeat_words == 33 and row.base_failed


# --- fingerprints ----------------------------------------------------------


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.default_rng(5)
    gaps = []
    for _ in range(60):
        words = [f"w{k}" for k in rng.integers(0, 200, 150)]
        other = words[: rng.integers(20, 150)] + [f"v{k}" for k in rng.integers(0, 200, 60)]
        a, b = collections.Counter(words), collections.Counter(other)
        truth = sum((a & b).values()) / sum((a | b).values())
        fa, fb = fingerprints.fingerprints([" ".join(words), " ".join(other)], 256)
        gaps.append(fingerprints.likeness(fa, fb) - truth)
    assert abs(np.mean(gaps)) < 0.03 and np.std(gaps) < 0.06


def test_long_text_in_parts_is_the_same(monkeypatch):
    whole = fingerprints.fingerprints([LONG, "x y x"])
    monkeypatch.setattr(fingerprints, "TERMS", 100)
    assert fingerprints.fingerprints([LONG, "x y x"]) == whole
    held, draw = [], fingerprints.variates
    monkeypatch.setattr(fingerprints, "variates", lambda terms, n: held.append(len(terms)) or draw(terms, n))
    assert fingerprints.fingerprints(["x y x", LONG]) == whole[::-1]
    assert max(held) <= 200


def test_edited_texts_and_neighbours(spark):
    docs = documents(spark)
    texts = texts_of(docs)
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in fingerprints.compare_neighbours(docs, range_rows=17).collect()}
    for k, doc in enumerate(order):
        text, other = texts[doc], texts[order[(k + 1) % len(order)]]
        cut = len(text) // 2
        edited = text[: len(text) - cut] + other[:cut]
        assert rows[doc].n_chars == len(text)
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, new, far = fingerprints.fingerprints([text, edited, other])
        assert rows[doc].near_edited == fingerprints.likeness(own, new)
        assert rows[doc].near_next == fingerprints.likeness(own, far) and rows[doc].fingerprint == own.hex()


# --- language model --------------------------------------------------------


def brute_ppm(train, text, order):
    counts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    data = lambda t: bytes([0xFE]) * order + b" ".join(common.words_of(t)) + bytes([0xFF])
    for t in train:
        d = data(t)
        for k, i in itertools.product(range(order + 1), range(order, len(d))):
            counts[k][d[i - k : i]][d[i]] += 1
    total, d = 0.0, data(text)
    for i in range(order, len(d)):
        excluded: set = set()
        for k in range(order, -1, -1):
            seen = counts[k].get(d[i - k : i])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in excluded}
            below = sum(left.values()) + len(left)
            if d[i] in left:
                total += math.log10(left[d[i]] / below)
                break
            if left:
                total += math.log10(len(left) / below)
            excluded |= set(seen)
        else:
            total -= math.log10(256 - len(excluded))
    return total


def test_scores_are_those_of_brute_force(spark):
    docs = documents(spark).filter("doc_id < 60")
    texts = {k: t[:600] for k, t in texts_of(docs).items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in lm_scoring.score_documents(docs, block_bytes=9000).collect()}
    training = [t for k, t in texts.items() if zlib.crc32(str(k).encode()) % 10]
    tokens = collections.Counter(w for t in training for w in [*common.words_of(t), b""])
    total = sum(tokens.values())
    for doc, text in texts.items():
        own = [*common.words_of(text), b""]
        base = sum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (len(tokens) + 1))) for w in own)
        r = rows[doc]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(own), total, sum(tokens[w] > 0 for w in own))
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 10 == 0)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(brute_ppm(training, text, 4))


def test_probabilities_of_a_context_sum_to_one(spark):
    text = "abracadabra aba"
    grams, n = np.unique(lm_scoring.gram_codes(common.words_of(text), 2), return_counts=True)
    context = int(grams[0]) >> 8
    asked = {(context << 8) | b: 0 for b in range(256)} | dict(zip(grams.tolist(), n.tolist()))
    rows = lm_scoring.ppm_log10(spark.createDataFrame(list(asked.items()), "gram bigint, n bigint"), 2).collect()
    assert sum(10**r.value for r in rows if r.gram >> 8 == context) == pytest.approx(1)


# --- sentence pieces -------------------------------------------------------

TEXTS = ["", " ", "a", "Hello  world", "\nBar\n\nfoo bar\n", "été ▁x ▁▁ y", "x" * 100, "日本語 text\t1", " lead", "tail ", "a \n b", LONG[:5000]]


def test_ids_are_the_librarys(spark):
    pieces = sentence_pieces.encoder(PIECES)
    for text in [*TEXTS, *list(texts_of(documents(spark)).values())[:60]]:
        ids, spans = pieces.encode(text)
        assert ids == pieces.library.encode(text), text[:50]
        data = text.encode()
        assert len(spans) == len(ids)
        if len(spans):
            assert spans[0][0] == 0 and spans[-1][1] == len(data) and (spans[1:, 0] == spans[:-1, 1]).all()
            for i, (a, b) in list(zip(ids, spans))[:300]:
                if not pieces.library.is_byte(i):
                    assert pieces.library.id_to_piece(i).replace("▁", " ").lstrip() == data[a:b].decode().replace("▁", " ").lstrip()


def test_compiled_map_is_read_as_the_library_reads_it():
    from sentencepiece import SentencePieceNormalizer

    for rule in ("nmt_nfkc", "nmt_nfkc_cf", "nfkc"):
        library = SentencePieceNormalizer(rule_name=rule)
        own = sentence_pieces.Normaliser(sentence_pieces.message_fields(sentence_pieces.message_fields(library.serialized_model_proto())[3][0]))
        for text in ["ＡＢＣ ﬁ ①  x", "  Ünḯcödé ", "ｶﾞ ㌔", "a​b", "", "   ", "plain text"]:
            normal, places = own.normalise(text)
            assert normal.decode() == library.normalize(text), (rule, text)
            assert len(places) == len(normal) + 1 and (np.diff(places) >= 0).all()


# --- quotations ------------------------------------------------------------


def test_replies_follow_what_they_quote(spark):
    rows = [
        (1, "user", "How do I fix it?\nIt is broken."),
        (2, "helper", "On Monday a wrote:\n> How do I   fix it?\n> It is BROKEN.\nTurn it off.\n\nThen on."),
        (3, "user", "> On Monday a wrote:\n>> How do I fix it?\n>> It is broken.\n> Turn it off.\n>\n> Then on.\nThanks."),
        (4, "other", "> Then on.\nWhy?"),
        (5, "user", "A new matter."),
        (6, None, None),
        (None, "user", "> A new matter.\nlost"),
    ]
    out = {r.message_id: r for r in chat_quotes.conversations(spark.createDataFrame(rows, "message_id bigint, role string, text string")).collect()}
    assert {k: (v.parent_id, v.root_id, v.depth) for k, v in out.items()} == {
        1: (None, 1, 0), 2: (1, 1, 1), 3: (2, 1, 2), 4: (2, 1, 2), 5: (None, 5, 0), 6: (None, 6, 0), None: (None, None, None),
    }
    assert out[2].text == "Turn it off.\n\nThen on." and out[3].quote_depth == 2 and out[4].text == "Why?"
    assert sorted(v.place for k, v in out.items() if k in (1, 2, 3, 4)) == [out[k].place for k in (1, 2, 3, 4)]


def test_replies_go_to_the_latest_holder(spark):
    rows = [
        (1, "a", "thanks"),
        (2, "b", "Shall we go?"),
        (3, "a", "On Monday b wrote:\n> Shall we go?\nthanks"),
        (4, "b", "> thanks\nSee you."),
        (5, "a", "Is it raining?"),
        (6, "b", "> Is it raining?\nthanks"),
        (7, "a", "thanks"),
        (8, "b", ">> Shall we go?\n> thanks\nDone."),
        (9, "b", "> thanks\nYes."),
    ]
    out = chat_quotes.conversations(spark.createDataFrame(rows, "message_id bigint, role string, text string")).collect()
    assert {r.message_id: r.parent_id for r in out} == {1: None, 2: None, 3: 2, 4: 3, 5: None, 6: 5, 7: None, 8: 3, 9: 7}
    assert {r.root_id for r in out if r.message_id in (2, 3, 4, 8)} == {2}


def test_last_holders_against_brute_force(spark):
    rng = np.random.default_rng(5)
    draw = lambda n: [(0, b"hot" if rng.random() < 0.4 else bytes([rng.integers(40)]), int(rng.integers(5000))) for _ in range(n)]
    held, asked = draw(3000), draw(3000)
    schema = "kind int, hash binary, id bigint"
    out = chat_quotes.last_holders(spark.createDataFrame(held, schema), spark.createDataFrame(asked, schema)).collect()
    want = collections.Counter()
    for kind, text, asker in set(asked):
        if earlier := [i for _, h, i in held if h == text and i < asker]:
            want[asker, kind, max(earlier)] += 1
    assert collections.Counter((r.id, r.kind, r.found) for r in out) == want


# --- importance ------------------------------------------------------------


def test_weights_and_choice(spark):
    docs = documents(spark)
    good = common.table(spark, SMALL, "labels").filter("quality = 1")
    rows = importance.importance_resample(docs, good, 0.5).collect()
    assert sum(r.kept for r in rows) == 100
    assert min(r.sample_key for r in rows if r.kept) >= max(r.sample_key for r in rows if not r.kept)
    texts, wanted = texts_of(docs), {r.doc_id for r in good.collect()}
    raw, target = np.ones(importance.BUCKETS), np.ones(importance.BUCKETS)
    for doc, text in texts.items():
        for f in importance.features(text, importance.BUCKETS):
            raw[f] += 1
            target[f] += doc in wanted
    ratio = np.log(target / target.sum() * raw.sum() / raw)
    for r in rows:
        assert r.log_weight == pytest.approx(ratio[importance.features(texts[r.doc_id], importance.BUCKETS)].sum())


# --- language --------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    found = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out and lang_pred <> 'und'").collect()
    assert len(held) > 150 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_rank_order_by_brute_force(spark):
    text = "Abc ab. abd"
    grams = collections.Counter()
    for word in re.findall("[a-z]+", text.lower()):
        padded = f"\x01{word}\x01"
        for n in (1, 2, 3):
            grams.update(g for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g.strip("\x01"))
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    expected = sorted(grams, key=lambda g: (-grams[g], code(g)))
    assert language_id.top_codes(text, 400).tolist() == [code(g) for g in expected]
    assert {r.lang_pred for r in language_id.language_id(odd(spark)).filter("doc_id in (1, 2, 3, 9)").collect()} == {"und"}


# --- near duplicates -------------------------------------------------------


def brute_components(texts):
    sets = {k: set(near_dedup.shingle_set(t, 3).tolist()) for k, t in texts.items()}
    part = {k: k for k in sets}

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            part[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}, {k: len(s) for k, s in sets.items()}


def test_components_are_those_of_brute_force(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    parts, sizes = brute_components(texts_of(docs))
    rows = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    assert {k: r.component_id for k, r in rows.items()} == parts
    assert {k: r.n_shingles for k, r in rows.items()} == sizes
    assert all(r.kept == (k == parts[k]) for k, r in rows.items())


def test_group_of_near_copies_without_a_common_centre(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(150)]
    texts = {}
    for doc in range(120):
        words = list(base)
        for k in rng.choice(150, rng.integers(0, 14), replace=False):
            words[k] = f"x{doc}y{k}"
        texts[doc] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    parts, _ = brute_components(texts)
    assert len(set(parts.values())) > 1
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == parts


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(50, 60), (60, 55)], "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {k: 1 for k in range(1, 41)} | {50: 50, 60: 50, 55: 50}


# --- packing ---------------------------------------------------------------


def test_every_token_lies_in_one_piece(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    docs = odd(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    docs = docs.select("doc_id", "text").union(documents(spark).select(common.F.col("doc_id") + 100, "text"))
    rows = packing.pack(docs, BYTES, task_tokens=30_000).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in texts_of(docs).items():
        ids = [*(library.encode(text, add_special_tokens=False).ids if text else []), 1]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.SEQUENCE and at & (at - 1) == 0  # no padding at all
    assert packing.pack(docs.filter("false"), BYTES).count() == 0
    assert packing.pack(odd(spark), BYTES).filter("doc_id is null").count() >= 1


def test_hilbert_curve_moves_by_one_cell():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# --- archives --------------------------------------------------------------


def test_pages_come_back(spark, tmp_path):
    long = "<p>" + "WARC/1.1\r\n\r\n\x00é" * 4000
    rows = [(4, "http://a", "x"), (2, None, long), (3, "u\nv", "x"), (9, "u", None), (5, "u", ""), (5, "u", ""), (None, "n", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"), segment=500, archive_bytes=20_000)
    found = warc.read_archives(spark, str(tmp_path / "w"))
    assert found.count() == len(rows) and found.filter("not complete").count() == 0
    assert found.filter("page_id = 2").first().payload.decode() == long
    out = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_records(found).collect())
    assert out == [(0, 1, "response", None), (2, len(long.encode()), "response", None), (3, 1, "response", None), (4, 1, "revisit", 3),
                   (5, 0, "response", None), (5, 0, "response", None), (9, 0, "revisit", 5)]


def test_broken_records_are_told(spark):
    part = lambda n, block, total=None: ("o", n, total, 1, "response" if n == 1 else "continuation", None, "D", block)
    message = warc.HEAD + warc.chunked(b"hello")
    whole = [part(1, message[:50]), part(2, message[50:], len(message))]
    assert warc.assembled(whole)[1] == b"hello"
    for broken in ([whole[0]], [whole[1]], [whole[0], part(3, message[50:], len(message))], [whole[0], part(2, message[50:], 1)]):
        assert warc.assembled(broken)[1] is None and warc.assembled(broken)[5] is False
    assert warc.unchunked(b"5\r\nhel") is None and warc.unchunked(b"z\r\n") is None


def test_no_archive_from_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.page_records(warc.read_archives(spark, str(tmp_path / "w"))).count() == 0
