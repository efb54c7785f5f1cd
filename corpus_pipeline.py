"""From raw documents to packed training sequences, a stage at a time.

Each stage takes all that the one before kept, as a table; all but the last return the columns of documents.
"""

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from delaykit.llm.common import stored, table  # noqa: E402
from delaykit.llm.language_id import keep_known  # noqa: E402
from delaykit.llm.near_dedup import keep_one  # noqa: E402
from delaykit.llm.packing import pack  # noqa: E402
from delaykit.llm.quality_rules import keep_good  # noqa: E402

#: Texts whose n-grams lie this far from every profile are in none of the languages.
LEAST_LANGUAGE_SCORE = 0.2
#: Near duplicates share so many per cent of their shingles of so many words.
DUPLICATE_WORDS, DUPLICATE_PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no language's profile comes near."""
    return keep_known(docs, LEAST_LANGUAGE_SCORE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that fail a rule, and documents that lose too much by it."""
    return keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near duplicates."""
    return keep_one(docs, words=DUPLICATE_WORDS, percent=DUPLICATE_PERCENT)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("near_dedup", one_of_each),
    ("packing", packed),
]
#: SQL can state neither rank-order profiles nor tokens; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
