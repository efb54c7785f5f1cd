"""Buckets, indexes, vectors, forest, training and daily jobs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from delaykit.operators import ml
from delaykit.plans import daily, training
from delaykit.plans.features import extract_features, feature_job
from delaykit.plans.requests import prepare_requests, respond, score, score_indexed
from delaykit.schemas import FEATURES
from delaykit.sources import files
from delaykit.sources.models import load_model, save_model

FLIGHTS = (
    "FlightNum string, FlightDate string, DayOfWeek string, DayofMonth string, Carrier string, Origin string,"
    " Dest string, Distance double, DepDelay double, ArrDelay double, CRSDepTime string, CRSArrTime string"
)


def flights(spark):
    airports = ["ATL", "SFO", "JFK", "LAX"]
    data = []
    for i in range(400):
        dep = float(i % 80 - 30)
        arr = dep + 3 if i % 50 else None
        o, d = airports[i % 4], airports[(i // 4) % 4]
        day = 1 + i % 28
        data.append((str(i % 30), f"2015-12-{day:02d}", str(1 + i % 7), str(day), "AA" if i % 3 else "DL", o, d,
                     100.0 + i % 5, dep, arr, "2330", "0110"))
    return spark.createDataFrame(data, FLIGHTS)


@pytest.fixture(scope="module")
def labelled(spark):
    return ml.trainable(extract_features(flights(spark))).cache()


@pytest.fixture(scope="module")
def model(labelled):
    return ml.train(labelled, seed=1)


def test_bucket_edges(spark):
    values = [-15.1, -15.0, -0.1, 0.0, 29.9, 30.0, None]
    df = spark.createDataFrame([(v,) for v in values], "ArrDelay double")
    assert [r.ArrDelayBucket for r in ml.delay_bucket(df).collect()] == [0.0, 1.0, 1.0, 2.0, 2.0, 3.0, None]
    nan = spark.createDataFrame([(float("nan"),)], "ArrDelay double")
    with pytest.raises(Exception):
        ml.delay_bucket(nan).collect()
    assert ml.delay_bucket(nan, "keep").first().ArrDelayBucket == 4.0


def test_trainable_drops_what_cannot_be_learned(spark):
    base = extract_features(flights(spark).limit(3))
    bad = base.withColumn("ArrDelay", F.lit(float("nan"))).unionByName(base.withColumn("Distance", F.lit(None).cast("double")))
    assert ml.trainable(bad).count() == 0


def test_index_order_and_unseen_values(spark):
    data = [("b", "x", "y"), ("a", "x", "y"), ("c", "x", "z"), ("c", "x", "z")]
    df = spark.createDataFrame(data, "Carrier string, Origin string, Dest string").withColumn("Route", F.concat_ws("-", "Origin", "Dest"))
    indexes = ml.index_categories(df)
    assert list(indexes.labelsArray[0]) == ["c", "a", "b"]
    unseen = spark.createDataFrame([("zz", None, "y", "x-y")], df.schema)
    row = indexes.transform(unseen).first()
    assert (row.Carrier_index, row.Origin_index, row.Dest_index) == (3.0, 1.0, 0.0)
    with pytest.raises(Exception):
        ml.index_categories(df, "error").transform(unseen).collect()


def test_assembler_refuses_or_keeps_nulls(spark):
    columns = ml.NUMERIC_COLUMNS + ml.INDEX_COLUMNS
    df = spark.range(1).select(*[F.lit(1.0).alias(c) for c in columns[1:]], F.lit(None).cast("double").alias(columns[0]))
    with pytest.raises(Exception):
        ml.assembler().transform(df).collect()
    vector = ml.assembler("keep").transform(df).first().Features_vec
    assert len(vector) == 9 and vector[0] != vector[0]


def test_bins_follow_the_largest_category(labelled):
    wide = labelled.withColumn("Route", F.concat("Route", F.lit("#"), (F.monotonically_increasing_id() % 40).cast("string")))
    fitted = ml.train(wide, seed=1, num_trees=2)
    assert len(fitted.stages[0].labelsArray[3]) > 32
    assert fitted.stages[2].getMaxBins() == len(fitted.stages[0].labelsArray[3]) + 1


def test_saved_model_scores_the_same(spark, labelled, model, tmp_path):
    save_model(model, str(tmp_path / "m"))
    loaded = load_model(str(tmp_path / "m"))
    keep = ["FlightNum", "FlightDate", "Route", "DepDelay", "Prediction"]
    one = score(model, labelled).select(keep).orderBy(*keep).collect()
    assert one == score(loaded, labelled).select(keep).orderBy(*keep).collect()
    assert not {"rawPrediction", "probability", "Features_vec"} & set(score(model, labelled).columns)


def test_copies_stay_on_one_side_of_the_split(spark, labelled):
    doubled = labelled.union(labelled).repartition(7)
    fitting, held = ml.split_holdout(doubled)
    assert fitting.count() + held.count() == doubled.count() and held.count() > 0
    assert fitting.select("FlightNum", "FlightDate", "Route", "DepDelay").intersect(
        held.select("FlightNum", "FlightDate", "Route", "DepDelay")
    ).count() == 0


def test_training_job_reports(spark, tmp_path):
    table = str(tmp_path / "features")
    extract_features(flights(spark)).write.parquet(table)
    model, reports = training.train_job(spark.read.parquet(table), str(tmp_path / "model"), seed=1)
    accuracy = {r.split: r for r in reports["accuracy"].collect()}
    assert set(accuracy) == {"training", "holdout"} and accuracy["training"].accuracy > 0.5
    assert reports["nulls"].count() == 0
    assert sum(r.n for r in reports["distribution"].collect()) == accuracy["holdout"].n
    assert load_model(str(tmp_path / "model")).stages[2].getNumTrees == model.stages[2].getNumTrees == 20


def test_feature_job_writes_sorted_typed_lines(spark, tmp_path):
    source, target = str(tmp_path / "flights"), str(tmp_path / "features")
    flights(spark).write.parquet(source)
    feature_job(spark, source, target)
    df = files.read_features(spark, target)
    assert df.count() == 392
    row = df.first()
    assert (row.DayOfYear, row.DayOfMonth, row.FlightDate) == (335, 1, date(2015, 12, 1))
    assert (row.CRSDepTime, row.CRSArrTime) == (datetime(2015, 12, 1, 23, 30), datetime(2015, 12, 2, 1, 10))
    table = training.load_training_table(spark, target, "delay_test.training", "parquet")
    assert table.schema == FEATURES and table.count() == 392
    sampled = str(tmp_path / "sampled")
    feature_job(spark, source, sampled, fraction=0.5)
    assert 120 < files.read_features(spark, sampled).count() < 280


def _requests(spark):
    data = [
        ("u1", "ATL", "SFO", "AA", "2015-12-05", 60.0, "1"),
        ("u2", "SFO", "ATL", "ZZ", "2015-12-06", None, None),
        ("u3", None, "ATL", "AA", "2015-12-06", 1.0, "3"),
        ("u4", "ATL", "SFO", "AA", "not a date", 1.0, "4"),
    ]
    df = spark.createDataFrame(data, "UUID string, Origin string, Dest string, Carrier string, FlightDate string, DepDelay double, FlightNum string")
    return df.withColumn("Timestamp", F.lit(datetime(2015, 12, 4, 10)))


DISTANCES = [("ATL", "SFO", 2139.0)]


def test_prepared_requests_are_scored(spark, model):
    distances = spark.createDataFrame(DISTANCES, "Origin string, Dest string, Distance double")
    scorable, rejected = prepare_requests(_requests(spark), distances)
    assert [r.UUID for r in rejected.collect()] == ["u3"]
    known = scorable.filter("UUID != 'u4'")
    out = {r.uuid: r for r in respond(model, known).collect()}
    assert out["u1"].distance == 2139.0 and out["u1"].day_of_week == 6 and out["u1"].prediction == 3.0
    assert out["u2"].distance == 0.0 and out["u2"].dep_delay == 0.0 and out["u2"].route == "SFO-ATL"


def test_requests_with_indexes_of_their_own(labelled, model):
    keep = ["FlightNum", "FlightDate", "Route", "DepDelay", "Prediction"]
    indexed = model.stages[0].transform(labelled)
    own = score_indexed(model, indexed).select(keep).orderBy(*keep).collect()
    assert own == score(model, labelled).select(keep).orderBy(*keep).collect()
    unknown = indexed.limit(3).withColumn("Route_index", F.lit(None).cast("double"))
    assert score_indexed(model, unknown).filter("Prediction IS NOT NULL").count() == 3


def test_daily_jobs(spark, model, tmp_path):
    root = str(tmp_path)
    distances = spark.createDataFrame(DISTANCES, "Origin string, Dest string, Distance double")
    scorable, _ = prepare_requests(_requests(spark), distances)
    scorable.write.parquet(f"{root}/store")
    for _ in range(2):
        daily.fetch_day(spark, "2015-12-04", root, f"{root}/store", fmt="parquet")
        daily.score_day(spark, "2015-12-04", root, model)
    daily.load_day(spark, "2015-12-04", root, f"{root}/results", fmt="parquet")
    results = spark.read.parquet(f"{root}/results").orderBy("DepDelay").collect()
    # The request without a usable date has no calendar parts and is not scored.
    assert [(r.Route, r.Prediction is not None) for r in results] == [("SFO-ATL", True), ("ATL-SFO", True)]
    assert results[0].Timestamp == datetime(2015, 12, 4, 10)


def test_rows_alike_are_counted_and_drawn_as_two(spark, labelled):
    copies = labelled.limit(40).crossJoin(spark.range(1, 26).select(F.lit(0))).select(labelled.columns)
    counted = ml.counted_rows(copies)
    assert counted.agg(F.sum(ml.ROWS)).first()[0] == copies.count()
    dealt = ml._dealt(counted, 8)
    assert dealt.rdd.getNumPartitions() == 8 and dealt.count() == 2 * counted.count()
    assert dealt.agg(F.sum(ml.WEIGHT)).first()[0] == copies.count()
    single = ml.counted_rows(labelled.dropDuplicates([*ml.NUMERIC_COLUMNS, *ml.CATEGORY_COLUMNS, ml.LABEL]))
    assert ml._dealt(single, 8).count() == single.count()


def test_forest_reads_many_copies_as_weighted_rows(spark, labelled):
    copies = labelled.crossJoin(spark.range(30).select(F.lit(0))).select(labelled.columns)
    fitted = ml.train(copies, seed=1, num_trees=2)
    assert fitted.stages[2].getWeightCol() == ml.WEIGHT
    assert fitted.stages[2].summary.predictions.count() <= 2 * ml.counted_rows(labelled).count()
    # Indexes follow the rows, not the distinct ones.
    assert fitted.stages[0].labelsArray == ml.index_categories(copies).labelsArray
    # The layout of the rows makes no difference.
    again = ml.train(copies.repartition(13), seed=1, num_trees=2)
    assert fitted.stages[2].toDebugString.partition("\n")[2] == again.stages[2].toDebugString.partition("\n")[2]


def test_forest_reads_every_row_where_few_are_alike(labelled):
    fitted = ml.train(labelled.union(labelled), seed=1, num_trees=2)
    assert not fitted.stages[2].isSet("weightCol")
    assert fitted.stages[2].summary.predictions.count() == 2 * labelled.count()


def test_few_kinds_of_rows_suffice_for_the_bins(labelled):
    few = labelled.dropDuplicates(["Route"]).limit(3)
    copies = few
    for _ in range(4):
        copies = copies.union(few)
    fitted = ml.train(copies, seed=1, num_trees=2, max_bins=4)
    assert fitted.stages[2].getNumTrees == 2 and fitted.stages[2].getWeightCol() == ml.WEIGHT


def test_counted_rows_are_evaluated_as_their_rows(spark, labelled, model):
    copies = labelled.union(labelled.filter("DepDelay > 0"))
    counted = ml.counted_rows(copies)
    assert counted.count() < copies.count()
    assert ml.evaluate(model, all=counted).collect() == ml.evaluate(model, all=copies).collect()


def test_training_job_counts_each_side_whole(spark, labelled, tmp_path):
    table = str(tmp_path / "features")
    rows = extract_features(flights(spark))
    rows.union(rows).write.parquet(table)
    model, reports = training.train_job(spark.read.parquet(table), str(tmp_path / "model"), seed=1)
    sides = ml.split_holdout(ml.trainable(spark.read.parquet(table)), seed=1)
    accuracy = {r.split: r.n for r in reports["accuracy"].collect()}
    assert (accuracy["training"], accuracy["holdout"]) == tuple(side.count() for side in sides)
    expected = model.transform(sides[1]).groupBy("Prediction").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(reports["distribution"].collect()) == sorted(expected.collect())
