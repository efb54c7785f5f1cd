"""Helpers shared by the text operators."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit.session import new_work_dir

#: Java and RE2 pattern of the white space between words.
SPACE = r"[\x20\x09-\x0D]+"

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written below the shared working folder and read back.

    Cuts the lineage: a lost executor costs a read of files, not the work before.
    """
    path = f"{new_work_dir(df.sparkSession)}/{name}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def bucket_of(column: Column, n: int) -> Column:
    """CRC-32 of the column as text, modulo ``n``; null stays null."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (two multiply-xor-shift rounds)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; white space is that of ``SPACE``."""
    return text.encode().lower().split() if text else []
