"""Landed feeds, judgments, digests and history, read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.text import falsy
from gazette.functions.tokens import cluster_key, dedupe_key

JUDGMENT = "title string, summary_lines array<string>, importance_score int, category_label string, quality_label string, quality_tags array<string>, dedupe_key string, impact_signals array<struct<label:string,evidence:string>>, why string"
DIGEST_ITEM = "id string, date string, category string, title string, dedupe_key string, cluster_key string, status string, importance int, source_name string"
HISTORY = "date date, id string, dedupe_key string, cluster_key string, title string, summary string"


def rss_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of landed RSS files, one row each, with their place in the feed; broken files become corrupt rows."""
    item = "struct<title:string,link:string,description:string,pubDate:string,source:struct<_VALUE:string,_url:string>>"
    df = spark.read.format("xml").option("rowTag", "channel").option("mode", "PERMISSIVE").schema(f"title string, item array<{item}>, _corrupt_record string").load(path)
    df = df.select(F.input_file_name().alias("feed_id"), F.col("_corrupt_record").isNotNull().alias("corrupt"), F.posexplode_outer("item").alias("pos", "e"))
    return df.select("feed_id", "corrupt", "pos", "e.title", "e.link", F.col("e.description").alias("summary"), F.col("e.pubDate").alias("published"), F.trim(F.coalesce("e.source._VALUE", F.lit(""))).alias("source"))


def landed_xml(spark: SparkSession, path: str) -> DataFrame:
    """Entries of feeds landed as RSS under path/feed=<id>, in file order; what a broken file still gives stays, with a corrupt row beside it.

    (feed_id, corrupt, pos, title, link, summary, published, source). pos counts a feed's entries from 0.
    """
    item = "title string, link string, description string, pubDate string, source struct<_VALUE:string,_url:string>, _corrupt_record string"
    df = spark.read.format("xml").option("rowTag", "item").option("mode", "PERMISSIVE").schema(item).load(path)
    corrupt = F.col("_corrupt_record").isNotNull()
    place = F.row_number().over(Window.partitionBy("feed", corrupt).orderBy(F.input_file_name(), F.monotonically_increasing_id())) - 1
    outlet = F.trim(F.coalesce("source._VALUE", F.lit("")))
    told = lambda c: F.when(~corrupt, F.col(c))
    found = df.select(F.col("feed").cast("string").alias("feed_id"), corrupt.alias("corrupt"), F.when(~corrupt, place).alias("pos"), told("title").alias("title"), told("link").alias("link"), told("description").alias("summary"), told("pubDate").alias("published"), F.when(~corrupt, outlet).alias("source"))
    # a file that doesn't end as a feed is broken too: the reader may find nothing in it at all
    open_ = spark.read.option("wholetext", True).text(path).where(~F.rtrim(F.col("value")).rlike("</(?:rss|channel)>\\s*$")).select(F.col("feed").cast("string").alias("feed_id")).distinct()
    return found.unionByName(open_.withColumn("corrupt", F.lit(True)), allowMissingColumns=True)


def landed_json(spark: SparkSession, path: str) -> DataFrame:
    """The same of feeds landed as lines of JSON (pos, title, link, summary, published, source); a line that can't be read is a corrupt row."""
    line = "pos int, title string, link string, summary string, published string, source struct<title:string>, _corrupt_record string"
    df = spark.read.schema(line).option("mode", "PERMISSIVE").json(path)
    corrupt = F.col("_corrupt_record").isNotNull()
    return df.select(F.col("feed").cast("string").alias("feed_id"), corrupt.alias("corrupt"), F.when(~corrupt, F.col("pos")).alias("pos"), F.when(~corrupt, F.col("title")).alias("title"), "link", "summary", "published", F.trim(F.coalesce("source.title", F.lit(""))).alias("source"))


def json_entries(spark: SparkSession, path: str) -> DataFrame:
    schema = "feed_id string, pos int, topic string, title string, summary string, link string, content array<struct<value:string>>, published string, updated string, source struct<title:string>, _corrupt_record string"
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("full_text", F.concat_ws(" ", F.transform("content", lambda c: c["value"]))).withColumn("corrupt", F.col("_corrupt_record").isNotNull())


def judgments(raw: Column) -> Column:
    """A judgment from raw model text: as it is, its brace block, then the block without trailing commas; null if none parses."""
    bare = F.regexp_replace(raw, r"(?s)^\s*```[a-z]*\s*|\s*```\s*$", "")
    block = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    fixed = F.regexp_replace(block, r",\s*([}\]])", "$1")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    whole = lambda c: F.from_json(c, f"{JUDGMENT}, _bad string", options)
    good = lambda c: F.when(F.trim(c).startswith("{") & whole(c)["_bad"].isNull(), whole(c).dropFields("_bad"))
    return F.coalesce(good(bare), good(block), good(fixed))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Dated snapshots, as files YYYY-MM-DD.json or folders snapshot=YYYY-MM-DD; other names are left out, unreadable ones keep a row without items. A folder that isn't there has none."""
    schema = f"date string, items array<struct<{', '.join(f'{c.split()[0]}:{c.split()[1]}' for c in DIGEST_ITEM.split(', '))}>>, _corrupt_record string"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], f"{schema}, snapshot string")
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("snapshot", F.regexp_extract(F.input_file_name(), r"(?:snapshot=|/)(\d{4}-\d{2}-\d{2})(?:\.json$|/)", 1)).where("snapshot <> ''")


def union_feeds(*entries: DataFrame) -> DataFrame:
    """The entries of all feeds as one table, whatever format each came in; columns that a format lacks are null."""
    out = entries[0]
    for e in entries[1:]:
        out = out.unionByName(e, allowMissingColumns=True)
    return out


def last_edition(snapshots: DataFrame) -> DataFrame:
    """The items of the newest snapshot that has any; no rows where there is none."""
    newest = snapshots.where(F.size("items") > 0).agg(F.max("snapshot").alias("snapshot"))
    return snapshots.join(F.broadcast(newest), "snapshot").select(F.inline("items"))  # newest is one row


def archived(snapshots: DataFrame) -> DataFrame:
    """(snapshot, n): the published items of each dated snapshot, of all its documents; null where one couldn't be read."""
    shown = F.filter("items", lambda x: x["status"].isin("kept", "published"))
    return snapshots.groupBy("snapshot").agg(F.when(F.count("*") == F.count("items"), F.sum(F.size(shown)).cast("int")).alias("n"))


def recent_history(history: DataFrame, run_date: str, days: int, cfg: Config, prior: DataFrame | None = None) -> DataFrame:
    """(cluster_key, item_id): the latest row of each key within the days before the run date; no day means no row.

    A row has two keys: its cluster key (built from its dedupe key where it lacks one) and the one
    that its title and summary give. Where history has no row in range, the published items of the
    last edition (prior) stand in for it.
    """
    at = F.lit(run_date).cast("date")
    columns = ["date", "id", "dedupe_key", "cluster_key", "title", "summary"]
    within = F.col("date").cast("date").between(F.date_sub(at, days), F.date_sub(at, 1)) & F.lit(days > 0)
    recent = history.where(within).select(*columns)
    if prior is not None and recent.isEmpty():
        shown = prior.where(within & F.col("status").isin("kept", "published"))
        recent = shown.select(*(F.col(c) if c in prior.columns else F.lit("").alias(c) for c in columns))
    given = F.coalesce(falsy(F.col("cluster_key")), cluster_key(F.coalesce("dedupe_key", F.lit("")), None, cfg))
    rebuilt = cluster_key(dedupe_key(F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), cfg), F.concat_ws(" ", "title", "summary"), cfg)
    keyed = recent.select("date", F.col("id").alias("item_id"), F.explode(F.array_distinct(F.array(given, rebuilt))).alias("cluster_key"))
    return keyed.where(F.coalesce("cluster_key", F.lit("")) != "").groupBy("cluster_key").agg(F.max_by("item_id", F.struct("date", "item_id")).alias("item_id"))
