"""Time three choices against the plainer way of doing the same work.

    python bench_variants.py [folder]

Prints one JSON line: seconds of each way, median of three runs after a warm-up.
"""

import json
import statistics
import sys
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from delaykit.catalogue import views as V
from delaykit.catalogue.queries import rule_model
from delaykit.functions import roll_overnight, to_event_ts
from delaykit.operators.aggregates import null_profile
from delaykit.operators.filters import split_scorable
from delaykit.operators.requests import default_request, encode_rows, with_date_parts
from delaykit.plans.requests import respond
from delaykit.session import build_session, new_work_dir
from delaykit.streaming import scoring


def median(work):
    work()
    seconds = []
    for _ in range(3):
        start = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def discard(df):
    df.write.format("noop").mode("overwrite").save()


def null_counts_one_job_each(df):
    return [(c, df.filter(F.col(c).isNull()).count()) for c in df.columns]


def _row_times(row):
    """Plain Python version of the schedule times, for comparison only."""
    stamps = []
    for hhmm in (row.CRSDepTime, row.CRSArrTime):
        hour, minute = ("23", "59") if hhmm[:2] == "24" else (hhmm[:2], hhmm[2:])
        stamps.append(datetime.fromisoformat(f"{row.FlightDate} {hour}:{minute}:00"))
    departure, arrival = stamps
    return departure, arrival + timedelta(days=1) if arrival < departure else arrival


def main(sf_dir="/root/testdata/sf0.1"):
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "8",
    }
    spark = build_session("variants", conf, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    folder = new_work_dir(spark)
    V.flights(spark, sf_dir).write.parquet(f"{folder}/flights")
    flights = spark.read.parquet(f"{folder}/flights")

    dep, arr = (to_event_ts("FlightDate", c, ntz=True) for c in ("CRSDepTime", "CRSArrTime"))
    timed = flights.select(dep.alias("dep"), arr.alias("arr"))
    by_expression = timed.withColumn("arr", roll_overnight("dep", "arr"))
    schedule = flights.select("FlightDate", "CRSDepTime", "CRSArrTime")

    def by_python_rows():
        discard(spark.createDataFrame(schedule.rdd.map(_row_times), "dep timestamp_ntz, arr timestamp_ntz"))

    asked = V.requests(spark, sf_dir).withColumn("Timestamp", F.col("Timestamp").cast("string"))
    asked = with_date_parts(asked.withColumn("Distance", F.lit(100.0)))
    encode_rows(asked).write.text(f"{folder}/messages")
    batch = scoring.request_stream(spark.read.text(f"{folder}/messages"))
    model = rule_model()
    sinks = (
        scoring.keyed_table_sink(f"{folder}/table"),
        scoring.response_topic_sink(f"{folder}/topic", fmt="json"),
        scoring.reject_sink(f"{folder}/rejected"),
    )

    def without_persist():
        valid, rejected = split_scorable(default_request(batch))
        responses = respond(model, valid)
        sinks[0](responses, 0), sinks[1](responses, 0), sinks[2](rejected, 0)

    print(
        json.dumps(
            {
                "null_profile": {
                    "one_pass": median(lambda: null_profile(flights).collect()),
                    "one_job_per_column": median(lambda: null_counts_one_job_each(flights)),
                },
                "schedule_times": {
                    "expressions": median(lambda: discard(by_expression)),
                    "python_rows": median(by_python_rows),
                },
                "micro_batch": {
                    "persisted": median(lambda: scoring.process_batch(batch, 0, lambda: model, *sinks)),
                    "recomputed_per_sink": median(without_persist),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
