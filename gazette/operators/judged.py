"""The judgment side: what a model said of an article, put into the forms that later steps rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions import signals as sg
from gazette.functions.text import bound, clean_text, collapse, falsy, jaccard, mentions, summary_lines
from gazette.functions.tokens import dedupe_key, judged_key, lit_array, raw_tokens
from gazette.operators.filters import guardrail


def _level(signals: Column, levels: tuple[tuple[int, tuple[str, ...]], ...], default: int) -> Column:
    out = F.lit(default)
    for n, labels in reversed(levels):
        out = F.when(F.arrays_overlap(signals, lit_array(labels)), n).otherwise(out)
    return out


def importance(value: Column, signals: Column, cfg: Config) -> Column:
    """A judged importance held between 1 and 5; what isn't a whole number gives way to the signals' level."""
    given = F.when(F.trim(value).rlike(r"^[+-]?[0-9]+$"), F.trim(value).try_cast("bigint"))
    return F.coalesce(F.greatest(F.lit(1), F.least(F.lit(5), given)).cast("int"), _level(signals, cfg.fallback_levels, 2))


def quality_label(value: Column, cfg: Config) -> Column:
    """ok or low_quality: known words first, then fragments; nothing said is ok."""
    low = F.lower(collapse(F.coalesce(value, F.lit(""))))
    return F.when(low.isin(*cfg.low_words), "low_quality").when(low.isin(*cfg.ok_words), "ok").when(F.contains(low, F.lit("low")) | F.contains(low, F.lit("bad")), "low_quality").otherwise("ok")


def allowed_labels(values: Column, allowed: tuple[str, ...]) -> Column:
    """The allowed ones of an array, in order, each once, whatever their case."""
    low = F.transform(F.coalesce(values, lit_array(())), lambda x: F.lower(collapse(x)))
    return F.array_distinct(F.filter(low, lambda x: x.isin(*allowed)))


def category(value: Column, cfg: Config) -> Column:
    """The category whose synonym was said, else the first one of which a fragment occurs, else the empty string."""
    low = F.lower(collapse(F.coalesce(value, F.lit(""))))
    out = F.lit("")
    for name, _, fragments in reversed(cfg.judged_categories):
        out = F.when(mentions(low, fragments), name).otherwise(out)
    for name, synonyms, _ in reversed(cfg.judged_categories):
        out = F.when(low.isin(*synonyms), name).otherwise(out)
    return out


def why_text(signals: Column, cfg: Config) -> Column:
    """A stock reason by the row's signals; empty without any."""
    out = F.lit(cfg.why_default)
    for labels, said in reversed(cfg.why_texts):
        out = F.when(F.arrays_overlap(signals, lit_array(labels)), said).otherwise(out)
    return F.when(F.size(F.coalesce(signals, lit_array(()))) > 0, out).otherwise("")


def drop_text(reason: Column, cfg: Config) -> Column:
    """What readers are told of a dropped row."""
    out = F.lit(cfg.drop_default)
    for code, said in cfg.drop_texts:
        out = F.when(reason == code, said).otherwise(out)
    return out


def _similar(a: Column, b: Column) -> Column:
    """Two views (t: text, w: words): one holds the other, or their words' Jaccard is 0.8 or more. Nothing is similar to an empty text."""
    some = (F.length(a["t"]) > 0) & (F.length(b["t"]) > 0)
    return some & (F.contains(a["t"], b["t"]) | F.contains(b["t"], a["t"]) | (jaccard(a["w"], b["w"]) >= 0.8))


def judged_summary(lines: Column, title: Column, fallback: Column, cfg: Config) -> Column:
    """Up to 3 judged lines that say something; what is missing comes from the fallback's lines, at the least its first.

    A line is a sentence of 12 characters or one with a number, isn't a stock phrase or cut
    off, and isn't similar to the title or to a line before it.
    """
    view = lambda c: F.struct(c.alias("t"), F.array_distinct(raw_tokens(c)).alias("w"))
    views = lambda c: F.transform(F.filter(F.transform(c, collapse), lambda x: x != ""), view)

    def good(x: Column, named: Column) -> Column:
        long_enough = (F.length(x["t"]) >= 12) | x["t"].rlike("[0-9]")
        return long_enough & x["t"].rlike(r"[.?!]$") & ~mentions(x["t"], cfg.stock_phrases) & ~x["t"].rlike(r"…|\.\.\.") & ~_similar(x, named)

    def chosen(x: Column) -> Column:
        def add(kept: Column, line: Column) -> Column:
            fresh = (F.size(kept) < 3) & ~F.exists(kept, lambda k: _similar(line, k))
            return F.when(fresh, F.array_append(kept, line)).otherwise(kept)

        none = F.slice(F.array(x["title"]), 1, 0)
        ranked = F.filter(F.concat(x["lines"], x["more"]), lambda line: good(line, x["title"]))
        return bound(F.transform(F.aggregate(ranked, none, add), lambda k: k["t"]), lambda kept: F.when(F.size(kept) > 0, kept).otherwise(F.transform(F.slice(x["more"], 1, 1), lambda m: m["t"])))

    start = F.struct(views(F.coalesce(lines, lit_array(()))).alias("lines"), views(summary_lines(F.coalesce(fallback, F.lit("")), cfg)).alias("more"), view(collapse(F.coalesce(title, F.lit("")))).alias("title"))
    return bound(start, chosen)


def record(rows: DataFrame, judgments: DataFrame, cfg: Config) -> DataFrame:
    """item_id and the judged fields of rows(item_id, title, summary, full_text, signals, dedupe_key) that have a body and a judgment.

    judgments(item_id, raw_title, summary_lines, why, rationale, raw_key, impact_signals, raw_importance,
    raw_quality, raw_tags, raw_category). Only the first 6,000 characters of a body count, and of
    a body of under 400 characters no signal is a candidate: both are rules of the operator.
    """
    df = rows.withColumn("body", F.substring(collapse(F.coalesce("full_text", F.lit(""))), 1, 6000)).where("body <> ''").join(judgments, "item_id")
    df = df.withColumns({"title2": F.coalesce(falsy(collapse("raw_title")), "title"), "candidates": F.when(F.length("body") >= 400, sg.rule_signals(F.col("body"), cfg)).otherwise(lit_array(()))})
    df = df.withColumns({
        "lines": judged_summary(F.col("summary_lines"), F.col("title2"), F.col("summary"), cfg),
        "reason_why": F.coalesce(falsy(collapse("why")), why_text(F.col("signals"), cfg)),
        "detail": sg.judged_pairs(F.col("impact_signals"), F.col("candidates"), F.col("body"), cfg),
        "judged_importance": importance(F.col("raw_importance"), F.col("signals"), cfg),
        "tags": allowed_labels(F.col("raw_tags"), cfg.allowed_tags),
    })
    weak = guardrail(F.col("title2"), F.col("lines"), F.col("reason_why"), F.col("tags"), cfg)
    key = F.coalesce(falsy(judged_key(F.coalesce("raw_key", F.lit("")), cfg)), falsy(judged_key(F.coalesce("dedupe_key", F.lit("")), cfg)), dedupe_key(F.col("title2"), F.col("summary"), cfg))
    thin = F.when(F.col("judged_importance") <= 2, cfg.rationale_low).otherwise(F.coalesce(falsy(F.col("reason_why")), F.lit(cfg.rationale_default)))
    return df.select(
        "item_id", F.col("title2").alias("title"), "lines", F.col("reason_why").alias("why"), F.coalesce(falsy(collapse("rationale")), thin).alias("rationale"), key.alias("dedupe_key"),
        F.col("judged_importance").alias("importance"), F.transform("detail", lambda x: x["label"]).alias("labels"), "detail",
        F.when(weak.isNotNull(), "low_quality").otherwise(quality_label(F.col("raw_quality"), cfg)).alias("quality"), weak.alias("quality_reason"), "tags", category(F.col("raw_category"), cfg).alias("category"),
    )
