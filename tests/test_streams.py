"""The stateful suppression of recent repeats: days, state, restarts."""

import datetime

from pyspark.sql import functions as F

from gazette.plans.queries import _streamed
from gazette.streaming.recent import calendar_day, without_recent

SCHEMA = "n int, cluster_key string, published_at timestamp"


def run(spark, tmp_path, batches, **options):
    """Each batch is landed and judged by a run of its own, which goes on from the checkpoint."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    states = []
    for rows in batches:
        df = spark.createDataFrame(rows, "n int, cluster_key string, at string").select("n", "cluster_key", F.col("at").cast("timestamp").alias("published_at"))
        df.coalesce(1).write.mode("append").parquet(source)
        stream = without_recent(spark.readStream.schema(SCHEMA).parquet(source), **options)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start()
        query.awaitTermination()
        states.append(query.lastProgress.stateOperators[0].numRowsTotal)
    return sorted(r.n for r in spark.read.schema(SCHEMA).parquet(out).collect()), states


def test_whole_calendar_days_without_today(spark, tmp_path):
    # 14:59 and 15:00 UTC are two days at +09:00
    batches = [
        [(1, "a", "2024-01-01 01:00:00"), (2, "a", "2024-01-01 14:59:59"), (3, "b", "2024-01-01 15:00:00"), (4, None, "2024-01-01 01:00:00"), (5, "", "2024-01-01 01:00:00"), (6, "a", None)],
        [(7, "a", "2024-01-01 15:00:00"), (8, "a", "2024-01-04 14:59:59"), (9, "a", "2024-01-04 15:00:00"), (10, "b", "2024-01-02 14:00:00"), (11, None, "2024-01-02 01:00:00")],
        [(12, "a", "2024-01-05 16:00:00"), (13, "b", "2024-01-05 16:00:00"), (14, "a", "2024-01-05 01:00:00")],
    ]
    kept, _ = run(spark, tmp_path, batches, days=3, delay="2 days")
    # 7 and 8 fall into the three days after the first one; 9 is on the fourth; 14 is on the same day as 9; 10 on the same day as 3
    assert kept == [1, 2, 3, 4, 5, 6, 9, 10, 11, 13, 14]


def test_suppressed_rows_prolong_nothing(spark, tmp_path):
    days = [[(d, "a", f"2024-01-{d:02d} 03:00:00")] for d in range(1, 12)]
    assert run(spark, tmp_path, days, days=3, delay="2 days")[0] == [1, 5, 9]


def test_a_key_with_more_rows_than_an_arrow_batch_is_judged_by_day(spark, tmp_path):
    """One micro-batch in several chunks whose days come latest first, and a landed step of many files."""
    rows = [(d * 100 + k, "a", f"2024-01-{d:02d} 03:00:00") for d in range(11, 0, -1) for k in range(5)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        kept, _ = run(spark, tmp_path, [rows], days=3, delay="2 days")
        df = spark.createDataFrame(rows, "n int, cluster_key string, at string").select("n", "cluster_key", F.col("at").cast("timestamp").alias("published_at"))
        landed = _streamed(df.repartition(11, "n"), ["published_at < '2024-01-07'", "published_at >= '2024-01-07'"], days=3, delay="2 days")
        assert sorted(r.n for r in landed.collect()) == kept == [d * 100 + k for d in (1, 5, 9) for k in range(5)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_timers_clear_the_state(spark, tmp_path):
    first = [(k, f"k{k}", "2024-01-01 03:00:00") for k in range(20)]
    kept, states = run(spark, tmp_path, [first, [(100, "z", "2024-01-20 03:00:00")], [(101, "z2", "2024-01-21 03:00:00")]], days=3, delay="1 day")
    assert kept == [*range(20), 100, 101]
    assert states[0] >= 20 and states[-1] < 10  # the twenty keys and their timers are gone


def test_history_is_the_initial_state(spark, tmp_path):
    history = spark.createDataFrame([("a", "2024-01-03"), ("a", "2024-01-03"), ("b", "2023-12-30"), (None, "2024-01-03")], "cluster_key string, d string").select("cluster_key", F.col("d").cast("date").alias("date"))
    batches = [[(1, "a", "2024-01-04 03:00:00"), (2, "b", "2024-01-04 03:00:00"), (3, "c", "2024-01-04 03:00:00")], [(4, "a", "2024-01-07 03:00:00"), (5, "b", "2024-01-07 03:00:00")]]
    assert run(spark, tmp_path, batches, days=3, delay="2 days", history=history)[0] == [2, 3, 4]


def test_calendar_day_is_independent_of_the_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 14:59:59",), ("2024-01-01 15:00:00",), ("1969-12-31 14:59:59",)], "s string").select(calendar_day(F.to_timestamp("s")).alias("d"))
    assert [r.d for r in df.collect()] == [(datetime.date(2024, 1, 1) - datetime.date(1970, 1, 1)).days, (datetime.date(2024, 1, 2) - datetime.date(1970, 1, 1)).days, -1]
