"""Filters. A reject keeps its row and names a reason; reasons are counted later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.signals import long_labels, vocabulary
from gazette.functions.text import Lowered, Said, normalize_source, bound, collapse, contains_binary, jaccard, mentions
from gazette.functions.tokens import HANGUL, lit_array, raw_tokens


def structural(text: Column | Lowered | Said, signals: Column, category: Column, cfg: Config) -> Column:
    public = category.isin("policy", "international") & mentions(text, cfg.government)
    return F.arrays_overlap(signals, lit_array(cfg.structural_signals)) | mentions(text, cfg.policy_action) | mentions(text, cfg.structural) | public


def political_commentary(text: Column | Lowered | Said, cfg: Config) -> Column:
    return mentions(text, cfg.actors) & mentions(text, cfg.commentary) & ~mentions(text, cfg.policy_action)


def emotional_ok(text: Column | Lowered | Said, signals: Column, category: Column, cfg: Config) -> Column:
    return ~mentions(text, cfg.emotional) | structural(text, signals, category, cfg)


def fresh(age: Column, longs: Column, cfg: Config) -> Column:
    """No age passes; beyond the stale limit fails; beyond the fresh limit a long-run label is needed."""
    return F.when(age.isNull(), True).when(age > cfg.stale_hours, False).when(age > cfg.fresh_hours, F.size(longs) > 0).otherwise(True)


def top_fresh(age: Column, longs: Column, cfg: Config, required: bool = False) -> Column:
    return F.when(age.isNull(), not required).when(age <= cfg.top_fresh_hours, True).otherwise((F.size(longs) > 0) & (age <= cfg.stale_hours))


def source_allowed(source: Column, cfg: Config) -> Column:
    """The outlet, as it is or normalised, contains an allowed name of 3 or more characters. An empty outlet fails."""
    names = tuple(s for s in cfg.top_sources if len(s) >= 3)
    return mentions(source, names) | mentions(normalize_source(F.coalesce(source, F.lit("")), cfg), names)


def skip_vocabulary(cfg: Config) -> tuple[str, ...]:
    """All keywords that signals and skip_reason() look for in a text, in lower case."""
    lists = (cfg.hard_exclude, cfg.local_promo, cfg.exclude, cfg.structural, cfg.policy_action, cfg.government, cfg.actors, cfg.commentary, cfg.emotional)
    return tuple(dict.fromkeys((*vocabulary(cfg), *(w.lower() for words in lists for w in words))))


def skip_reason(text: Column | Lowered | Said, link: Column, matched: Column, signals: Column, age: Column, category: Column, cfg: Config) -> Column:
    """The first reason that holds, of nine in order; null for rows that pass."""
    context = structural(text, signals, category, cfg)
    return (
        F.when(mentions(text, cfg.hard_exclude), "hard_exclude_keyword")
        .when(mentions(link, cfg.hard_urls), "hard_exclude_url_hint")
        .when(mentions(text, cfg.local_promo), "local_promo")
        .when(mentions(text, cfg.exclude) & ~context, "exclude_keyword")
        .when(political_commentary(text, cfg), "political_commentary")
        .when(matched.isNotNull(), "recent_duplicate")
        .when(~context & (F.size(signals) == 0), "no_structural_signal")
        .when(~fresh(age, long_labels(text, signals, cfg), cfg), "freshness")
        .when(~emotional_ok(text, signals, category, cfg), "emotional_filter")
    )


def eligible(status: Column, drop_reason: Column) -> Column:
    return (status.isNull() | (status != "merged")) & (F.coalesce(drop_reason, F.lit("")) == "")


def url_dropped(url: Column, cfg: Config) -> Column:
    return mentions(url, cfg.hard_urls)


def body_reason(body: Column, status: Column, extractor: Column, least: int = 50) -> Column:
    """Reasons why a row can't be edited, joined by ';'; null if it can."""
    reasons = F.concat_ws(";", F.when(status >= 400, F.concat(F.lit("http_"), status.cast("string"))), F.when(extractor == "none", "no_extractor"), F.when(F.length(F.trim(F.coalesce(body, F.lit("")))) < least, "body_too_short"))
    return F.nullif(reasons, F.lit(""))


def outdated(published: Column, digest_date: Column, carried: Column, hours: float = 72.0) -> Column:
    gap = F.abs(F.unix_seconds(published.cast("timestamp")) - F.unix_seconds(digest_date.cast("timestamp"))) / 3600
    return F.coalesce(gap > hours, F.lit(False)) & ~F.coalesce(carried, F.lit(False))


#: How a calendar date may be written (months by name are an extension of ours): 2024-01-31 (or with dots or slashes), 2024년 1월 31일, January 31, 2024.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DATES = r"\d{4}[-./]\d{1,2}[-./]\d{1,2}|\d{4}년\s*\d{1,2}월\s*\d{1,2}일|(?:" + "|".join(m[:3] for m in MONTHS) + r")[a-z]*\.?\s+\d{1,2},?\s+\d{4}"


def _day(said: Column) -> Column:
    """The date that a matched string writes; null if there is no such day."""
    numbers = F.regexp_extract_all(said, F.lit(r"\d+"), F.lit(0))
    month = F.lit(None).cast("string")
    for k, name in enumerate(MONTHS):
        month = F.when(said.startswith(name[:3]), str(k + 1)).otherwise(month)
    parts = F.when(month.isNull(), numbers).otherwise(F.array(F.get(numbers, F.lit(1)), month, F.get(numbers, F.lit(0))))
    return F.try_to_timestamp(F.array_join(F.transform(parts, lambda x: F.lpad(x, F.greatest(F.length(x), F.lit(2)), F.lit("0"))), "-"), F.lit("yyyy-MM-dd")).cast("date")


def stale_incident(text: Column, base: Column, cfg: Config, days: int = 90) -> Column:
    """struct(stale, day): the oldest of the best-scored explicit dates, and whether it lies over `days` before the base date.

    A date scores 2 with an incident word at most 50 characters before or 60 after it, and 2 less
    with a word of results there; only what scores above 0 counts.
    """
    low = F.lower(collapse(F.coalesce(text, F.lit(""))))

    def found(x: Column) -> Column:
        pieces, dates = F.split(x, DATES, -1), F.regexp_extract_all(x, F.lit(DATES), F.lit(0))

        def scored(d: Column, i: Column, p: Column, ds: Column) -> Column:
            # what stands around: pieces and dates beside it are joined, and cut to the two distances
            before = F.concat(F.coalesce(F.concat(F.get(p, i - 1), F.get(ds, i - 1)), F.lit("")), F.get(p, i))
            after = F.concat(F.get(p, i + 1), F.coalesce(F.concat(F.get(ds, i + 1), F.get(p, i + 2)), F.lit("")))
            near = F.concat(F.substring(before, F.greatest(F.length(before) - 49, F.lit(1)), F.lit(50)), d, F.substring(after, 1, 60))
            score = F.when(mentions(near, cfg.incident_words), 2).otherwise(0) - F.when(mentions(near, cfg.result_words), 2).otherwise(0)
            return F.struct((-score).alias("score"), _day(d).alias("day"))

        both = bound(F.struct(pieces.alias("p"), dates.alias("d")), lambda y: F.transform(y["d"], lambda d, i: scored(d, i, y["p"], y["d"])))
        best = F.get(F.array_sort(F.filter(both, lambda d: (d["score"] < 0) & d["day"].isNotNull())), F.lit(0))["day"]
        return F.when(mentions(x, cfg.incident_words) & x.rlike(DATES), best)

    day = lambda best: F.struct(F.coalesce(F.datediff(base, best) > days, F.lit(False)).alias("stale"), best.alias("day"))
    return bound(bound(low, found), day)


def title_like(title: Column, lines: Column) -> Column:
    """Every line repeats the title: equal, contained, or token Jaccard of 0.85 or more."""
    flat = lambda c: F.lower(collapse(F.regexp_replace(c, f"[^0-9A-Za-z{HANGUL}\\s]", " ")))
    view = lambda c: F.struct(flat(c).alias("t"), F.array_distinct(raw_tokens(c)).alias("w"))
    same = lambda t, x: (x["t"] == t["t"]) | F.contains(t["t"], x["t"]) | F.contains(x["t"], t["t"]) | (jaccard(x["w"], t["w"]) >= 0.85)
    every = lambda t: (F.size(lines) > 0) & (F.length(t["t"]) > 0) & F.forall(F.transform(lines, view), lambda x: same(t, x))
    return bound(view(title), every)


def unusable(title: Column, lines: Column) -> Column:
    return F.when(F.exists(lines, contains_binary), "binary_text").when(title_like(title, lines), "title_only")


def low_quality(quality: Column, importance: Column, policy: str) -> tuple[Column, Column]:
    """(drop reason, importance) under the policy `drop` or `downgrade`."""
    low = quality == "low_quality"
    if policy == "drop":
        return F.when(low, "low_quality"), importance
    return F.lit(None).cast("string"), F.when(low, F.least(importance, F.lit(1))).otherwise(importance)


def script(c: Column) -> Column:
    hangul = F.length(F.regexp_replace(c, f"[^{HANGUL}]", ""))
    latin = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    return F.when(hangul > latin, "hangul").when(latin > 0, "latin").otherwise("other")


def integrity(title: Column, key: Column, judged: Column, rule: Column) -> Column:
    """Reason to drop: under 20 % of the title's tokens in the key, or judged and rule views that share too little."""
    sets = F.struct(*(F.array_distinct(raw_tokens(c)).alias(n) for c, n in ((title, "t"), (key, "k"), (judged, "a"), (rule, "b"))))

    def reason(x: Column) -> Column:
        shared = F.size(F.array_intersect(x["a"], x["b"]))
        apart = (F.size(x["a"]) >= 6) & (F.size(x["b"]) >= 6) & (shared < 0.2 * F.least(F.size(x["a"]), F.size(x["b"]))) & (jaccard(x["a"], x["b"]) <= 0.05) & (script(judged) == script(rule))
        return F.when((F.size(x["t"]) > 0) & (F.size(F.array_intersect(x["t"], x["k"])) < 0.2 * F.size(x["t"])), "title_key_mismatch").when(apart, "view_mismatch")

    return bound(sets, reason)


def guardrail(title: Column, lines: Column, why: Column, tags: Column, cfg: Config) -> Column:
    """The first reason for low quality: a tag, a redundant summary, too little in the summary, too little in the why."""
    joined = F.concat_ws(" ", lines)
    tagged = F.arrays_overlap(tags, lit_array(cfg.allowed_tags))
    twice = F.size(F.array_distinct(F.transform(lines, lambda x: F.lower(collapse(x))))) < F.size(lines)
    told = F.arrays_overlap(raw_tokens(why), raw_tokens(title)).cast("int") + why.rlike("[0-9]").cast("int") + mentions(why, cfg.structural).cast("int")
    return F.when(tagged, "tagged").when(twice | title_like(title, lines), "redundant_summary").when(F.length(joined) < 80, "low_information_summary").when(told < 2, "low_information_why")


def simple_incident(title: Column, summary: Column, cfg: Config) -> Column:
    return mentions(F.concat_ws(" ", title, summary), cfg.incident_words)


#: Kinds of urls.
MEDIA = r"(?i)\.(?:jpe?g|png|gif|webp|svg|mp4|mp3|avi|mov|pdf|zip)$"
PORTALS = ("news.google.com", "www.google.com", "www.youtube.com", "www.facebook.com")


def url_class(url: Column) -> Column:
    host, path = F.lower(F.try_parse_url(url, F.lit("HOST"))), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    parts = F.size(F.filter(F.split(path, "/"), lambda x: x != ""))
    return F.when(host.isNull(), "invalid").when(path.rlike(MEDIA) | host.rlike("^(?:img|image|video|cdn)[.]"), "media").when(host.isin(*PORTALS), "portal").when(parts == 0, "root").when((parts == 1) & (F.length(path) < 12), "section").otherwise("article")


def article_gate(text: Column, cfg: Config, least: int = 50) -> Column:
    """Reason to reject a page's text; null if it reads like an article. Dashes alone don't make a listing: two section names or, with fewer, three ellipses do."""
    low = F.lower(text)
    count = lambda words: F.size(F.filter(lit_array([w.lower() for w in words]), lambda w: F.contains(low, w)))
    dashes, dots = F.size(F.split(text, " - ", -1)) - 1, F.size(F.split(text, "…", -1)) - 1
    return (
        F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) < least, "too_short")
        .when(count(cfg.script_marks) >= 3, "script")
        .when(count(cfg.style_marks) >= 3, "style")
        .when((count(cfg.boilerplate) >= 2) | (count(cfg.strong_marks) >= 1), "policy")
        .when(count(cfg.login_marks) >= 1, "login")
        .when(((dashes >= 4) & (count(cfg.section_hints) >= 2)) | ((dots >= 3) & (dashes >= 2)), "listing")
    )


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("drop_reason", F.coalesce(df["drop_reason"], reason) if "drop_reason" in df.columns else reason)
