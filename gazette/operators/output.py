"""The published row: what readers get of a picked article."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.signals import inferred_importance
from gazette.functions.text import collapse, falsy, staged
from gazette.operators.judged import drop_text


def output_rows(rows: DataFrame, cfg: Config) -> DataFrame:
    """Kept and merged rows of each date in pick order, without keys that repeat among kept ones, as they are published.

    rows(date, pick_rank, item_id, title, lines, resolved_url, link, published_at, updated_at, source, category,
    why, rationale, detail, longs, importance, quality, quality_reason, dedupe_key, cluster_key, status, drop_reason).
    The resolved url comes before the link, the publication before the update. A row without
    signals is worth 2 at most, one without a judged importance what its signals say.
    """
    dropped = F.col("drop_reason").isNotNull() & (F.col("status") != "merged") | (F.col("status") == "dropped")
    df = rows.withColumn("status", F.coalesce("status", F.when(F.col("drop_reason").isNotNull(), "dropped").otherwise("kept"))).where(~dropped)
    counted = staged(df, key=collapse(F.coalesce("dedupe_key", F.lit(""))))
    # a row that doesn't count stands alone, so that all go through one window and rows are made once
    own = F.col("status").isin("kept", "published") & (F.col("key") != "")
    counted = counted.withColumns({"alone": F.when(~own, F.monotonically_increasing_id()), "key": F.when(own, F.col("key"))})
    w = Window.partitionBy("date", "key", "alone").orderBy("pick_rank", "item_id")
    first = counted.withColumn("n", F.row_number().over(w)).where("n = 1")
    labels = F.transform("detail", lambda x: x["label"])
    worth = F.coalesce("importance", inferred_importance(labels, F.col("longs"), cfg))
    reason = F.coalesce(falsy(collapse("quality_reason")), F.when(F.col("quality") == "low_quality", drop_text(F.lit("low_quality"), cfg)), F.lit(cfg.quality_default))
    place = F.row_number().over(Window.partitionBy("date").orderBy("pick_rank", "item_id"))
    return first.select(
        F.concat_ws("_", "date", place).alias("id"), "item_id", "date", "category", "title", "lines",
        F.coalesce(falsy(collapse("why")), F.lit(cfg.why_missing)).alias("why"), F.coalesce(falsy(collapse("rationale")), F.lit(cfg.rationale_default)).alias("rationale"),
        "detail", "dedupe_key", "cluster_key", F.col("source").alias("source_name"), F.coalesce(falsy(F.trim("resolved_url")), "link").alias("source_url"),
        F.coalesce("published_at", "updated_at").alias("published_at"), "status", F.when(F.size("detail") == 0, F.least(worth, F.lit(2))).otherwise(worth).alias("importance"),
        F.coalesce("quality", F.lit("ok")).alias("quality"), reason.alias("quality_reason"),
    )
