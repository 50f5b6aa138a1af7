"""The article table that the queries work on, and the derived columns of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.config import DEFAULT, Config
from gazette.functions import signals, text, tokens
from gazette.operators import filters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as articles. Title is the first line, summary the second; no text is read further for them."""
    body = F.coalesce("text", F.lit(""))
    two = F.substring_index(body, "\n", 2)
    summary = F.when(F.contains(two, F.lit("\n")), F.substring_index(two, "\n", -1)).otherwise("")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.substring_index(body, "\n", 1).alias("title"), summary.alias("summary"), body.alias("full_text"), "source", "lang", "n_chars")


def with_events(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return rows.join(events.select(F.col("event_id").alias("item_id"), F.col("event_type").alias("topic"), F.col("ts").alias("published_at"), "value"), "item_id", "left")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their event (topic, time)."""
    return with_events(spark, sf_dir, texts(spark, sf_dir))


def link(c="item_id", source="source"):
    """A stable url for a row of documents, which has none."""
    return F.concat(F.lit("https://"), F.col(source), F.lit(".example/"), F.when(F.col(c) % 17 == 0, "ads/").otherwise("item/"), F.col(c).cast("string"))


def derived(spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT, among: DataFrame | None = None, reasons: bool = True) -> DataFrame:
    """Of all articles, or those among a few items: row-local columns: link, age, signals, long labels, read time, score, category, skip reason. No shuffle beyond the article join.

    What depends on the text alone comes before the join, so a text that nobody reads later isn't
    shuffled. It is lowered once and each keyword is looked up once; each step is staged, since filters
    by score or reason would pull the whole derivation into every mention of a column. Nothing is
    pruned from a stage either, so skip reasons can be left out where nobody reads them.
    """
    words = filters.skip_vocabulary(cfg) if reasons else signals.vocabulary(cfg)
    rows = texts(spark, sf_dir)
    rows = rows if among is None else rows.join(F.broadcast(among.select("item_id")), "item_id", "left_semi")
    df = text.staged(rows, low=text.lowered(F.col("full_text")))
    df = text.staged(df, said=text.flags(F.col("low"), words), seconds=text.read_time(F.col("full_text"))).drop("low")
    said = text.Said(F.col("said"), words)
    df = text.staged(df, signals=signals.impact_signals(said, cfg))
    df = text.staged(df, longs=signals.long_labels(said, F.col("signals"), cfg))
    boost = signals.source_boost(signals.source_weight(F.col("source"), cfg))
    df = text.staged(df, score=F.round(signals.score(F.col("signals"), F.col("longs"), F.col("seconds"), boost), 6))
    df = with_events(spark, sf_dir, df).withColumn("link", link())
    df = text.staged(df, age=text.age_hours(F.col("published_at"), F.lit(None).cast("timestamp"), cfg), category=text.topic_category(F.col("topic"), cfg))
    if reasons:
        df = text.staged(df, reason=filters.skip_reason(said, F.col("link"), F.lit(None).cast("string"), F.col("signals"), F.col("age"), F.col("category"), cfg))
    return df.drop("said")


def keyed(spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT, scored: bool = True, among: DataFrame | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
    """Derived rows with dedupe key, cluster key, numbers, entities and rank, as the duplicate passes need them. Without scores: articles with keys alone.

    only: which of reason, cluster_key, numbers, entities, events, action and key_prefix are needed
    (all, unless it is given); others aren't computed, since a stage is never pruned.
    """
    df = derived(spark, sf_dir, cfg, among, only is None or "reason" in only) if scored else articles(spark, sf_dir)
    df = text.staged(df, said1=tokens.raw_tokens(F.col("title")), said2=tokens.raw_tokens(F.col("summary")))
    df = text.staged(df, dedupe_key=tokens.key_of(F.col("said1"), F.col("said2"), cfg))
    own, spoken = tokens.key_tokens(F.col("dedupe_key")), F.concat("said1", "said2")
    told = {
        "cluster_key": tokens.cluster_of(F.col("dedupe_key"), F.col("said1"), cfg),
        "numbers": F.array_distinct(F.filter(spoken, lambda t: t.rlike("^[0-9]+$"))),
        "entities": F.slice(F.array_distinct(tokens.entities(own, cfg)), 1, 8),
        "events": tokens.labelled(spoken, cfg.event_labels),
        "action": F.get(F.array_intersect(spoken, tokens.lit_array(cfg.actions)), F.lit(0)),
        "key_prefix": F.array_join(F.slice(own, 1, 3), "-"),
    }
    told = {name: c for name, c in told.items() if only is None or name in only}
    df = text.staged(df, **told) if told else df
    return df.drop("said1", "said2").withColumns({"id": F.col("item_id"), **({"rank": -F.col("score")} if scored else {})})
