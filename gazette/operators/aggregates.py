"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ingest_metrics(rows: DataFrame) -> DataFrame:
    """Rows per (feed, outcome), per feed and in all, in one pass. Feed and outcome are null in totals."""
    return rows.groupingSets([["feed_id", "outcome"], ["feed_id"], []], "feed_id", "outcome").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def feed_health(entries: DataFrame) -> DataFrame:
    """failure: corrupt and no entries; warning: corrupt with entries."""
    df = entries.groupBy("feed_id").agg(F.max(F.col("corrupt").cast("int")).alias("corrupt"), F.count("title").alias("entries"))
    return df.select("feed_id", "entries", F.when((F.col("corrupt") == 1) & (F.col("entries") == 0), "failure").when(F.col("corrupt") == 1, "warning").otherwise("ok").alias("state"))


def merge_metrics(rows: DataFrame) -> DataFrame:
    return rows.where("merge_reason IS NOT NULL").groupBy("merge_reason").agg(F.count("*").alias("n"))


def mix_stats(rows: DataFrame) -> DataFrame:
    """Rows per category and per source."""
    return rows.groupingSets([["category"], ["source"]], "category", "source").agg(F.count("*").alias("n"))


def allowlist_misses(rows: DataFrame, most: int = 10) -> DataFrame:
    """The outlets that the allow-list rejects most often (a top-k report)."""
    return rows.where("NOT allowed").groupBy(F.coalesce(F.nullif("source", F.lit("")), F.lit("(none)")).alias("source")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(most)


def digest_metrics(rows: DataFrame) -> DataFrame:
    """(metric, name, n): totals, drop reasons, labels, sources, categories and importance in one long table."""
    pair = lambda metric, name: F.struct(F.lit(metric).alias("metric"), name.cast("string").alias("name"))
    fixed = F.array(pair("total", F.lit("in")), pair("total", F.when(F.col("drop_reason").isNull(), "out").otherwise("dropped")), pair("source", F.col("source")), pair("category", F.col("category")), pair("importance", F.col("importance")))
    dropped = F.filter(F.array(pair("drop_reason", F.col("drop_reason"))), lambda x: x["name"].isNotNull())
    long = rows.select(F.explode(F.concat(fixed, dropped, F.transform("signals", lambda s: pair("label", s)))).alias("x"))
    return long.groupBy("x.metric", "x.name").agg(F.count("*").alias("n"))


def archive_index(rows: DataFrame) -> DataFrame:
    """Per date the kept rows; `latest` marks the newest date."""
    by_date = rows.groupBy("date").agg(F.count_if(F.col("status").isin("kept", "published")).alias("n_items"))
    newest = rows.agg(F.max("date").alias("newest"))
    return by_date.join(F.broadcast(newest)).select("date", "n_items", (F.col("date") == F.col("newest")).alias("latest"))


def merged_sources(rows: DataFrame) -> DataFrame:
    """Per kept item the mentions merged into it, in rank order."""
    mentions = F.array_sort(F.collect_list(F.struct("rank", "title", "source")))
    return rows.where("matched_to IS NOT NULL").groupBy("matched_to").agg(F.transform(mentions, lambda x: F.struct(x["title"].alias("title"), x["source"].alias("source"))).alias("mentions"), F.count("*").alias("n"))
