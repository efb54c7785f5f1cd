"""Sentence pieces by the operator's own merging and alignment, against the library."""

import random

import pytest
import public_tokenizers
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor

from delaykit.llm import common, sentence_pieces
from tests.conftest import SMALL

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   ", "\n", "\n\n a", " \n", "a", "▁", "▁▁a ▁", "  two  spaces  ", "x" * 5000, "ab" * 3000, "日本語 text\t1", "été", "​ a",
    "<s> </s> <unk> <0x41> <0x0A>", "𝒳 ﬁ ①", "ＡＢＣ　ｶﾞ", "\x00\x01", "\r\n ", "👩‍👩‍👧 ok", "a b", "ÅÅ", "㌔ x",
]


def varint(value):
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def with_rule(rule, folder):
    """The model with the character map of another rule, as a file."""
    with open(PIECES, "rb") as file:
        data = file.read()
    fields = sentence_pieces.message_fields(data)
    fields[3] = sentence_pieces.message_fields(SentencePieceNormalizer(rule_name=rule).serialized_model_proto())[3]
    path = folder / f"{rule}.model"
    path.write_bytes(b"".join(varint(k << 3 | 2) + varint(len(v)) + v for k in (1, 2, 3) for v in fields[k]))
    return str(path)


def random_texts(n):
    rng = random.Random(4)
    letters = "aeinrst   \n\t▁.,019éß中日本ﬁ①Ａ́👩"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(n)]


def held_against_library(path, texts):
    own, library = sentence_pieces.PieceEncoder(path), SentencePieceProcessor(model_file=path)
    assert own.own
    for text in texts:
        ids, spans = own.encode(text)
        assert ids == library.encode(text), text[:80]
        for piece, (begin, end) in zip(library.encode(text, return_type="proto").pieces, spans.tolist()):
            if not library.is_byte(piece.id):
                assert (piece.begin, piece.end) == (begin, end), (text[:80], piece.piece)


def test_merged_ids_and_spans_are_the_librarys(spark):
    texts = [r.text or "" for r in common.table(spark, SMALL.replace("0.001", "0.01"), "documents").select("text").collect()]
    held_against_library(PIECES, ODD + random_texts(3000) + texts)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc"])
def test_with_a_character_map(spark, tmp_path, rule):
    texts = [r.text or "" for r in common.table(spark, SMALL, "documents").select("text").collect()]
    held_against_library(with_rule(rule, tmp_path), ODD + random_texts(2000) + [t[:3000] for t in texts[:40]])


def test_a_model_whose_words_cannot_be_cut(tmp_path):
    own = sentence_pieces.PieceEncoder(PIECES)
    own.by_word = False
    for text in ODD + random_texts(200):
        assert own.encode(text)[0] == own.library.encode(text), text[:80]


def test_short_and_long_words_merge_alike():
    own = sentence_pieces.PieceEncoder(PIECES)
    for text in random_texts(2000):
        assert own.merged_short(text) == own.merged_long(text), text
