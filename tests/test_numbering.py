"""Running numbers over a table."""

import pytest
from pyspark.sql import functions as F

from delaykit import session
from delaykit.operators.numbering import numbered


def test_numbers_follow_the_order_without_gaps(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3).alias("g")).repartition(7)
    found = numbered(df, [F.desc("g"), "k"]).collect()
    wanted = sorted(found, key=lambda r: (-r.g, r.k))
    assert [r.number for r in wanted] == list(range(5000))


def test_numbers_of_many_copies_and_of_nothing(spark):
    df = spark.range(1000).select(F.lit("x").alias("k"), F.lit(None).cast("int").alias("v"))
    found = numbered(df, ["k", "v"], "n")
    assert found.columns == ["k", "v", "n"]
    assert sorted(r.n for r in found.collect()) == list(range(1000))
    assert numbered(df.filter("false"), ["k"]).count() == 0


def test_working_folders_are_shared_on_clusters():
    session.check_shared("local[8]", "file:///")
    session.check_shared("yarn", "hdfs://names:8020")
    for file_system in ("file:///", None):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.check_shared("yarn", file_system)
