"""Validation of output rows and of whole editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.signals import evidence_key, keywords, pairs, repaired, sanitized, stands_in, too_short, valid_pair
from gazette.functions.text import Lowered, bound, collapse, mentions, staged
from gazette.functions.tokens import cluster_key, dedupe_key, lit_array, normal_of, raw_tokens, valid_length
from gazette.operators.filters import stale_incident

#: Errors that drop a row; that are mended, or drop it if they can't be; that only lower its rank.
HARD = ("OUTDATED", "STALE_INCIDENT")
MISSING = "SIGNALS_MISSING"
SOFT = ("LOW_QUALITY_MISMATCH", "SIGNALS_REQUIRED")


def fixable(cfg: Config) -> tuple[str, ...]:
    return ("BAD_FORMAT", "DUPLICATE_LABEL", "DUPLICATE_EVIDENCE", "KEY_MISALIGNED", "CLUSTER_MISALIGNED", "UNKNOWN_LABEL", "EVIDENCE_REQUIRED", "SHORT_EVIDENCE", *(f"INVALID_{label.upper()}" for label, _ in cfg.signals), MISSING)


def low_quality_excused(cfg: Config) -> Column:
    """A low row may stay if it says that nothing could be judged, or if it gives a reason and claims little (columns why, rationale, importance, quality_reason)."""
    silent = (collapse(F.col("why")) == cfg.why_missing) & (collapse(F.col("rationale")) == cfg.rationale_low) & (F.col("importance") == 1)
    return silent | ((F.col("quality_reason") != "") & (F.col("importance") <= 2))


def item_errors(cfg: Config) -> Column:
    """Ordered distinct error codes of a row with the columns that complete() gives."""
    source = F.coalesce(F.nullif(F.col("full_text"), F.lit("")), "summary")
    told = collapse(F.concat_ws(" ", "title", "summary"))

    def of_pair(x: Column, low: Column) -> Column:
        invalid = F.when(~valid_pair(x["label"], x["evidence"], cfg), F.concat(F.lit("INVALID_"), F.upper(x["label"])))
        return F.when(~x["label"].isin(*keywords(cfg)), "UNKNOWN_LABEL").when(x["evidence"] == "", "EVIDENCE_REQUIRED").when(too_short(x["evidence"]), "SHORT_EVIDENCE").when((source != "") & ~stands_in(x["evidence"], Lowered(low)), "EVIDENCE_REQUIRED").otherwise(invalid)

    labels, evidence = F.transform("detail", lambda x: x["label"]), F.filter(F.transform("detail", lambda x: evidence_key(x["evidence"])), lambda k: k != "")
    words = bound(raw_tokens(told), lambda raw: F.array_union(F.filter(raw, valid_length), normal_of(raw, cfg)))
    shared = lambda key, sign, ws: F.size(F.array_intersect(F.array_distinct(F.filter(raw_tokens(F.replace(F.col(key), F.lit(sign), F.lit(" "))), valid_length)), ws))
    # what both keys are held against is made once, and the text is lowered once for all pairs
    aligned = bound(words, lambda ws: F.array(F.when(shared("dedupe_key", "-", ws) < 2, "KEY_MISALIGNED"), F.when(shared("cluster_key", "/", ws) < 1, "CLUSTER_MISALIGNED")))
    of_pairs = F.when(F.size("detail") == 0, lit_array(())).otherwise(bound(F.lower(collapse(source)), lambda low: F.transform("detail", lambda x: of_pair(x, low))))
    whole = F.array(
        F.when(F.col("malformed"), "BAD_FORMAT"),
        F.when(F.size(F.array_distinct(labels)) < F.size(labels), "DUPLICATE_LABEL"),
        F.when(F.size(F.array_distinct(evidence)) < F.size(evidence), "DUPLICATE_EVIDENCE"),
    )
    bare = (F.col("importance") >= 3) & (F.size("detail") == 0)
    late = F.array(
        F.when((F.col("quality") == "low_quality") & ~low_quality_excused(cfg), "LOW_QUALITY_MISMATCH"),
        F.when(bare, "SIGNALS_REQUIRED"),
        F.when(bare & mentions(told, cfg.alignment_triggers), MISSING),
        F.when(F.col("outdated"), "OUTDATED"),
        F.when(F.col("stale"), "STALE_INCIDENT"),
    )
    return F.array_distinct(F.array_compact(F.concat(whole, aligned, of_pairs, late)))


def complete(rows: DataFrame) -> DataFrame:
    """Rows with every column that the checks read. What a caller doesn't have: well-formed signals, no reasons, no second judgment."""
    have = {
        "malformed": F.lit(False), "quality_reason": F.lit(""), "why": F.lit(""), "rationale": F.lit(""),
        "retry_detail": pairs(), "retry_importance": F.lit(None).cast("int"),
    }
    return rows.withColumns({c: F.coalesce(c, default) if c in rows.columns else default for c, default in have.items()})


def handled(rows: DataFrame, cfg: Config) -> DataFrame:
    """Errors, fixes and the action: fix, check again, clear signals, check again, decide.

    Fixable errors have signals repaired, sanitised and keys made anew; a row of high importance
    without signals takes those of a second judgment. If only fixable errors are left, the signals
    are cleared. Missing signals behind a trigger word, what can't be fixed, old rows and old
    incidents drop a row. Soft errors lower it: low quality from 3 or more to 2 and from 2 to 1,
    signals that are only missing from 3 or more to 2. A row is modified if anything was fixed.
    """
    codes = fixable(cfg)
    some = lambda c: F.arrays_overlap(c, lit_array(codes))
    has = lambda c, *these: F.arrays_overlap(c, lit_array(these))
    text = F.coalesce(F.nullif(F.col("full_text"), F.lit("")), "summary")
    df = staged(complete(rows), errors_0=item_errors(cfg)).withColumn("_fix", some("errors_0"))
    df = staged(df, _repair=F.when(F.col("_fix"), repaired(F.col("detail"), text, cfg)))
    df = staged(df, _clean=F.when(F.col("_fix"), sanitized(F.col("_repair.pairs"), text, cfg)))
    retried = F.col("_fix") & has("errors_0", MISSING) & (F.size("retry_detail") > 0)
    rekeyed = has("errors_0", "KEY_MISALIGNED", "CLUSTER_MISALIGNED")
    df = df.withColumns({
        "detail": F.when(retried, F.col("retry_detail")).when(F.col("_fix"), F.col("_clean")).otherwise(F.col("detail")),
        "importance": F.when(retried & (F.coalesce("retry_importance", F.lit(0)) != 0), F.greatest(F.lit(1), F.least(F.lit(5), F.col("retry_importance")))).otherwise(F.col("importance")),
        "malformed": F.col("malformed") & ~F.col("_fix"),
        "dedupe_key": F.when(rekeyed, dedupe_key(F.col("title"), F.col("summary"), cfg)).otherwise(F.col("dedupe_key")),
        "fixes": F.when(F.col("_fix"), F.concat("_repair.fixes", F.array_compact(F.array(F.when(F.col("_clean") != F.col("_repair.pairs"), "sanitised"), F.when(rekeyed, "new_keys"), F.when(retried, "second_judgment"))))).otherwise(lit_array(())),
        "_rekeyed": rekeyed,
    })
    df = df.withColumn("cluster_key", F.when(F.col("_rekeyed"), cluster_key(F.col("dedupe_key"), F.concat_ws(" ", "title", "summary"), cfg)).otherwise(F.col("cluster_key")))
    df = staged(df, errors_1=item_errors(cfg))
    lost = has("errors_1", MISSING)
    clear = ~lost & some("errors_1") & ~has("errors_1", *HARD) & (F.size("detail") > 0)
    df = df.withColumns({"_lost": lost, "_clear": clear}).withColumn("detail", F.when(F.col("_clear"), pairs()).otherwise(F.col("detail")))
    df = staged(df, errors_2=F.when(F.col("_clear"), item_errors(cfg)).otherwise(F.col("errors_1")))
    reason = F.when(F.col("_lost"), "signals_missing").when(has("errors_2", "STALE_INCIDENT"), "stale_incident").when(has("errors_2", "OUTDATED"), "outdated").when(some("errors_2"), "validation_error")
    low, bare = ~F.col("_lost") & has("errors_2", "LOW_QUALITY_MISMATCH"), ~F.col("_lost") & has("errors_2", "SIGNALS_REQUIRED")
    lowered = F.when(low & (F.col("importance") > 2), 2).when(low & (F.col("importance") > 1), 1).otherwise(F.col("importance"))
    blank = F.col("quality_reason") == ""
    df = df.withColumns({
        "drop_reason": reason,
        "fixes": F.when(F.col("_clear"), F.array_append("fixes", F.lit("signals_cleared"))).otherwise(F.col("fixes")),
        "importance": F.when(bare & (lowered >= 3), 2).otherwise(lowered),
        "quality_reason": F.when(F.col("_lost") & blank, "signals_missing").when(low & blank, cfg.quality_low_reason).otherwise(F.col("quality_reason")),
        "quality": F.when(F.col("_lost"), "low_quality").otherwise(F.col("quality")),
    })
    action = F.when(F.col("drop_reason").isNotNull(), "dropped").when(F.size("fixes") > 0, "modified").otherwise("kept")
    return df.withColumn("action", action).drop("_fix", "_repair", "_clean", "_rekeyed", "_lost", "_clear")


def log_rows(rows: DataFrame, run_id: str) -> DataFrame:
    """What the validation log holds of each row: its errors before and after, the fixes and the action."""
    return rows.select(F.lit(run_id).alias("run_id"), "item_id", F.col("errors_0").alias("original_errors"), F.col("fixes").alias("auto_fixed"), F.col("errors_2").alias("remaining_errors"), F.col("action").alias("final_action"))


def edition_code(cfg: Config, hours: float = 72.0) -> Column:
    """The first rule that a published row breaks, or null. Fields count as missing where they are null; dates are calendar days at +09:00."""
    missing = F.lit(False)
    for c in cfg.required_fields:
        missing = missing | F.col(c).isNull()
    shown = F.col("status").isin("kept", "published") & ~F.coalesce("carried", F.lit(False))
    told = collapse(F.concat_ws(" ", "title", F.concat_ws(" ", "lines")))
    labels, evidence = F.transform("detail", lambda x: x["label"]), F.filter(F.transform("detail", lambda x: evidence_key(x["evidence"])), lambda k: k != "")
    late = F.abs(F.unix_seconds(F.col("published_at").cast("timestamp")) - (F.unix_seconds(F.col("date").cast("date").cast("timestamp")) - 9 * 3600)) > hours * 3600

    def of_pair(x: Column) -> Column:
        invalid = F.when(~valid_pair(x["label"], x["evidence"], cfg), F.concat(F.lit("INVALID_"), F.upper(x["label"])))
        return F.when(~x["label"].isin(*keywords(cfg)), "UNKNOWN_LABEL").when(x["evidence"] == "", "EVIDENCE_REQUIRED").when(too_short(x["evidence"]), "SHORT_EVIDENCE").otherwise(invalid)

    return (
        F.when(missing, "MISSING_FIELD")
        .when(shown & late, "OUTDATED")
        .when(shown & stale_incident(told, F.col("date").cast("date"), cfg)["stale"], "STALE_INCIDENT")
        .when((F.col("quality") == "low_quality") & (F.col("status") != "dropped") & ~low_quality_excused(cfg), "LOW_QUALITY_MISMATCH")
        .when(F.col("malformed"), "BAD_FORMAT")
        .when(F.size(F.array_distinct(labels)) < F.size(labels), "DUPLICATE_LABEL")
        .when(F.size(F.array_distinct(evidence)) < F.size(evidence), "DUPLICATE_EVIDENCE")
        .otherwise(F.coalesce(F.get(F.array_compact(F.transform("detail", of_pair)), F.lit(0)), F.when((F.col("importance") >= 3) & (F.size("detail") == 0), "SIGNALS_REQUIRED"), F.when((F.col("title") == "") | (F.col("source_url") == "") | (F.size("lines") == 0), "INVALID")))
    )


def editions_valid(rows: DataFrame, cfg: Config, least: int = 5) -> DataFrame:
    """digest_valid() over published rows of all editions: each row's code first, then one aggregate by date.

    A field that the table lacks is missing from every row. Optional: carried, malformed, pos.
    """
    lacking = {c: F.lit(None).cast("string") for c in cfg.required_fields if c not in rows.columns}
    df = rows.withColumns(lacking | {c: F.coalesce(c, F.lit(False)) if c in rows.columns else F.lit(False) for c in ("carried", "malformed")})
    if lacking:
        df = df.withColumn("code", F.lit("MISSING_FIELD"))
    else:
        df = df.withColumn("code", edition_code(cfg))
    return digest_valid(df, cfg, least)


def digest_valid(rows: DataFrame, cfg: Config, least: int = 5) -> DataFrame:
    """(date, n_items, valid, code) of each edition: its size, then a key that repeats among shown rows, then the first code of its rows (date, pos, code, dedupe_key, status)."""
    shown = F.col("status").isin("kept", "published") if "status" in rows.columns else F.lit(True)
    key = F.when(shown, F.nullif(collapse(F.col("dedupe_key")), F.lit("")))
    first = F.min_by("code", F.when(F.col("code").isNotNull(), F.col("pos")))
    # staged: the aggregate sorts by the key, and would make an expression anew for each comparison
    per = staged(rows, shown_key=key).groupBy("date").agg(F.count("*").alias("n_items"), (F.count("shown_key") - F.countDistinct("shown_key")).alias("repeats"), first.alias("first_code"))
    code = F.when(F.col("n_items") < least, "TOO_FEW_ITEMS").when(F.col("n_items") > cfg.top_limit, "TOO_MANY_ITEMS").when(F.col("repeats") > 0, "DUPLICATE_KEY").otherwise(F.coalesce("first_code", F.lit("ok")))
    return per.select("date", "n_items", code.alias("code"), (code == "ok").alias("valid"))


def numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy("date").orderBy("pick_rank", "item_id")))
