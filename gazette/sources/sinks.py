"""Sinks: dated editions, history, logs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.operators import validation


def write_dated(rows: DataFrame, path: str) -> None:
    """Replace the dates in rows and no others; the committer swaps whole partitions."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def nested(rows: DataFrame, order: str = "pick_rank", by: tuple[str, ...] = ("date",)) -> DataFrame:
    """One row per date with its items as an array; an edition has at most `top_limit` items."""
    items = F.array_sort(F.collect_list(F.struct(order, *[c for c in rows.columns if c not in (*by, order)])))
    return rows.groupBy(*by).agg(items.alias("items"))


def write_snapshots(rows: DataFrame, path: str, order: str = "pick_rank", most: int = 2000) -> None:
    """One JSON document per date under path/snapshot=<date>. A date of more than `most` items has several, each a file, so no document or array grows with its date."""
    place = F.row_number().over(Window.partitionBy("date").orderBy(order, *[c for c in rows.columns if c not in ("date", order)]))
    paged = rows.withColumn("page", F.floor((place - 1) / most)).repartition("date", "page")
    documents = nested(paged, order, ("date", "page")).select("date", "items", F.col("date").alias("snapshot"))
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 1).partitionBy("snapshot").json(path)


def upsert_history(history: DataFrame, today: DataFrame, run_date: str, days: int) -> DataFrame:
    """Today's kept rows replace the date's old ones; dates outside the window go."""
    at = F.lit(run_date).cast("date")
    columns = ["date", "id", "dedupe_key", "cluster_key", "title", "summary"]
    new = today.where(F.col("status").isin("kept", "published")).select(*columns)
    old = history.where((F.col("date") < at) & (F.col("date") >= F.date_sub(at, days))).select(*columns)
    return old.unionByName(new.where(F.col("date") == at))


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def publish(rows: DataFrame, verdict: DataFrame, path: str) -> str:
    """Write an edition unless it is structurally invalid; too few items still go out. Rows with item errors abort."""
    bad = verdict.where("NOT valid").select("code").distinct().limit(8)
    codes = {r["code"] for r in bad.collect()}  # a handful of codes
    if codes & {"DUPLICATE_KEY", "MISSING_FIELD", "TOO_MANY_ITEMS"}:
        return "kept previous"
    if codes - {"TOO_FEW_ITEMS"}:
        raise ValueError(f"items with errors: {sorted(codes)}")
    write_dated(rows, path)
    return "published"


def publish_dates(rows: DataFrame, verdict: DataFrame, path: str) -> None:
    """Write the dates whose edition is valid or only has too few items; the others keep what they had. A date with item errors aborts the run."""
    structural = ("DUPLICATE_KEY", "MISSING_FIELD", "TOO_MANY_ITEMS")
    bad = verdict.where(~F.col("valid") & ~F.col("code").isin("TOO_FEW_ITEMS", *structural)).select("date", "code").limit(8).collect()
    if bad:
        raise ValueError(f"items with errors: {[tuple(r) for r in bad]}")
    write_dated(rows.join(verdict.where(~F.col("code").isin(*structural)).select("date"), "date", "left_semi"), path)


def read_dated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


class BrokenEdition(ValueError):
    """A row of an edition breaks a rule: nothing is published."""


#: Codes of an edition that is as it should be, or short, which still goes out; and of one that can't be an edition, so that the one before stays.
GOES_OUT, STAYS = ("ok", "TOO_FEW_ITEMS"), ("TOO_MANY_ITEMS",)


def _pointer(spark: SparkSession, path: str) -> dict[str, str]:
    """Which run each date's edition comes from; an entry a date."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    file = hadoop.Path(f"{path}/current.json")
    if not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file):
        return {}
    return json.loads("".join(r.value for r in spark.read.text(f"{path}/current.json").collect()))


def swap_editions(rows: DataFrame, path: str, run: str, header: dict[str, Column], cfg: Config) -> dict[str, str]:
    """Publish the editions in rows, several dates as one; returns the codes of those that stayed back.

    One object a date, with the header's fields and its items, is staged in a folder of the run.
    The staged rows are validated; then a small pointer file, which says for each date which run
    holds its edition, is written beside and renamed over the old one, so a reader sees all dates
    of before or all of now. A date with too many rows keeps the edition it had. A broken row, or
    a date that has nothing to keep, raises: the pointer is as it was, and the staged folder is
    never read. The rename is atomic on HDFS and local folders; on object stores it is as atomic
    as their rename. Two runs at the same time don't know of each other.
    """
    spark = rows.sparkSession
    staged = f"{path}/editions/run={run}"
    nested(rows, "pos").withColumns(header).write.mode("overwrite").json(staged)
    read = spark.read.schema(f"date string, items {rows_type(rows)}").json(staged)
    verdict = {r["date"]: r["code"] for r in validation.editions_valid(read.select("date", F.inline("items")), cfg).select("date", "code").collect()}  # a row a date
    broken = {d: c for d, c in verdict.items() if c not in GOES_OUT + STAYS}
    now = _pointer(spark, path)
    lost = {d: c for d, c in verdict.items() if c in STAYS and d not in now}
    if broken or lost:
        raise BrokenEdition(f"not published: {dict(sorted((broken | lost).items())[:8])}")
    now |= {d: run for d, c in verdict.items() if c in GOES_OUT}
    _renamed(spark, path, json.dumps(now, sort_keys=True))
    return {d: c for d, c in verdict.items() if c in STAYS}


def rows_type(rows: DataFrame) -> str:
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "date")
    return f"array<struct<{fields}>>"


def _renamed(spark: SparkSession, path: str, text: str) -> None:
    """Write the pointer beside and rename it over the old one in one step."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, old = hadoop.Path(f"{path}/.current.json.new"), hadoop.Path(f"{path}/current.json")
    conf = spark._jsc.hadoopConfiguration()
    out = new.getFileSystem(conf).create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(new.getFileSystem(conf).getUri(), conf)
    files.rename(files.makeQualified(new), files.makeQualified(old), options)


def read_editions(spark: SparkSession, path: str) -> DataFrame:
    """(date, items, the header's fields, run) of every date's current edition."""
    now = _pointer(spark, path)
    if not now:
        return spark.createDataFrame([], "date string, items array<struct<id:string>>, run string")
    found = spark.read.option("basePath", f"{path}/editions").json([f"{path}/editions/run={run}" for run in sorted(set(now.values()))])
    wanted = spark.createDataFrame(sorted(now.items()), "date string, run string")
    return found.withColumn("run", F.col("run").cast("string")).join(F.broadcast(wanted), ["date", "run"], "left_semi")  # an entry a date
