"""Settings and vocabularies of a run. Vocabularies are parameters; the defaults are small samples that suit the test tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    run_ts: str = "2024-01-04 00:00:00"
    # scans
    feed_cap: int = 150
    history_days: int = 3
    default_topic_limit: int = 3
    # text
    outlets: tuple[str, ...] = ("src0", "src1", "src2")
    media_suffixes: tuple[str, ...] = ("news", "times", "daily", "post")
    boilerplate: tuple[str, ...] = ("all rights reserved", "licensed under", "released under", "contact:", "subscribe")
    # tokens and keys
    stopwords: tuple[str, ...] = ("the", "and", "for", "with", "that", "this", "are", "was", "from", "not", "der", "die", "und", "les", "des", "que", "los", "las", "por", "para")
    aliases: tuple[tuple[str, str], ...] = (("licence", "license"), ("licensed", "license"))
    endings: tuple[str, ...] = ("tion", "ing", "ment", "ed", "es")
    noise_words: tuple[str, ...] = ("news", "report", "update", "today")
    org_suffixes: tuple[str, ...] = ("corp", "bank", "group", "license")
    event_labels: tuple[tuple[str, tuple[str, ...]], ...] = (("licence", ("license", "rights")), ("access", ("token", "secret")), ("abuse", ("idiot", "trash", "scum")))
    domain_labels: tuple[tuple[str, tuple[str, ...]], ...] = (("law", ("license", "rights", "version")), ("english", ("thnt", "onst", "erst")))
    relations: tuple[tuple[str, tuple[str, ...]], ...] = (("grant", ("released", "licensed")), ("deny", ("reserved", "worthless")))
    actions: tuple[str, ...] = ("released", "licensed", "reserved")
    # signals: label -> keywords, in the order of selection
    signals: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("policy", ("license", "rights reserved")),
        ("sanctions", ("worthless", "disgusting")),
        ("capex", ("released under", "version 3")),
        ("infra", ("general public", "apache")),
        ("security", ("token =", "secret", "password")),
        ("earnings", ("tion the", "ing the")),
        ("market-demand", ("trash", "clown", "loser")),
    )
    export_order: tuple[str, ...] = ("sanctions", "policy", "security", "capex", "infra", "earnings", "market-demand")
    sanctions_words: tuple[str, ...] = ("worthless",)
    trade_words: tuple[str, ...] = ("apache",)
    long_triggers: tuple[tuple[str, tuple[str, ...]], ...] = (("policy", ("general public", "all rights")), ("security", ("token =",)), ("infra", ("version",)), ("capex", ("version",)))
    base_levels: tuple[tuple[str, int], ...] = (("policy", 3), ("sanctions", 3), ("security", 3), ("infra", 3), ("capex", 3), ("earnings", 2), ("market-demand", 2))
    # filters
    hard_exclude: tuple[str, ...] = ("scum", "moron")
    hard_urls: tuple[str, ...] = ("/ads/", "/sponsored/")
    local_promo: tuple[str, ...] = ("pathetic",)
    exclude: tuple[str, ...] = ("idiot", "stupid")
    structural: tuple[str, ...] = ("license", "version", "token =")
    policy_action: tuple[str, ...] = ("released", "licensed")
    government: tuple[str, ...] = ("public",)
    actors: tuple[str, ...] = ("clown", "loser")
    commentary: tuple[str, ...] = ("trash", "worthless")
    emotional: tuple[str, ...] = ("disgusting",)
    structural_signals: tuple[str, ...] = ("policy", "sanctions", "capex", "infra", "security")
    fresh_hours: float = 36.0
    stale_hours: float = 60.0
    top_fresh_hours: float = 24.0
    top_sources: tuple[str, ...] = ("src0", "src3", "src12")
    tier_a: tuple[str, ...] = ("src0", "src1")
    tier_b: tuple[str, ...] = ("src2", "src3", "src4")
    min_score: float = 0.0
    incident_words: tuple[str, ...] = ("trash", "scum", "clown")
    # categories: (priority, fragment, category)
    categories: tuple[tuple[str, str], ...] = (("click", "economy"), ("purchase", "economy"), ("view", "culture"), ("log", "technology"), ("sign", "society"), ("err", "technology"))
    default_category: str = "international"
    # duplicates
    title_threshold: float = 0.55
    key_threshold: float = 0.35
    semantic_strict: float = 0.88
    semantic_relaxed: float = 0.85
    # page texts: marks of code, of style sheets and of log-in pages
    script_marks: tuple[str, ...] = ("function(", "var ", "window.", "document.", "=>")
    style_marks: tuple[str, ...] = ("{", "}", "px;", "margin:", "font-")
    #: One of these makes a licence page; two of the others make a listing, beside dashes.
    strong_marks: tuple[str, ...] = ("permission is hereby granted", "mit license")
    section_hints: tuple[str, ...] = ("economy", "latest", "markets")
    login_marks: tuple[str, ...] = ("log in", "sign in", "cookies")
    # numbers: one spelling for each unit
    currencies: tuple[str, ...] = ("usd", "eur", "gbp", "jpy", "krw")
    unit_aliases: tuple[tuple[str, str], ...] = (("$", "usd"), ("dollar", "usd"), ("dollars", "usd"), ("달러", "usd"), ("€", "eur"), ("£", "gbp"), ("¥", "jpy"), ("₩", "krw"), ("원", "krw"), ("won", "krw"), ("percent", "%"), ("bn", "billion"), ("mn", "million"))
    # selection
    top_limit: int = 20
    category_minimums: tuple[tuple[str, int], ...] = (("economy", 1), ("technology", 1), ("culture", 1))
    category_caps: tuple[tuple[str, int], ...] = (("society", 2), ("culture", 5))
    source_cap: int = 2
    capped_signals: tuple[str, ...] = ("policy", "earnings")
    signal_share: float = 0.3
    signal_slack: float = 0.7
    importance_targets: tuple[tuple[str, int], ...] = (("economy", 8), ("technology", 6), ("culture", 3), ("society", 3))
    importance_limit: int = 24
    semantic_limit: int = 32
    required_fields: tuple[str, ...] = ("id", "date", "category", "title", "lines", "why", "rationale", "detail", "dedupe_key", "source_name", "source_url", "published_at", "status", "importance", "quality", "quality_reason")
    allowed_tags: tuple[str, ...] = ("clickbait", "promo", "opinion", "rumor", "listing")
    # judgments: importance by signals; quality words; category, its synonyms and its fragments; stock texts
    fallback_levels: tuple[tuple[int, tuple[str, ...]], ...] = ((4, ("policy", "sanctions")), (3, ("capex", "infra", "security")))
    low_words: tuple[str, ...] = ("low_quality", "low", "bad", "reject")
    ok_words: tuple[str, ...] = ("ok", "good", "keep")
    judged_categories: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
        ("economy", ("economy", "macro", "click"), ("econom", "purchas")),
        ("technology", ("technology", "tech", "login"), ("softw", "logout")),
        ("culture", ("culture", "view"), ("cultur",)),
        ("society", ("society", "signup"), ("social",)),
        ("international", ("international", "world"), ("global",)),
    )
    stock_phrases: tuple[str, ...] = ("click here", "read more", "of the")
    why_texts: tuple[tuple[tuple[str, ...], str], ...] = (
        (("policy", "sanctions"), "Rules change, and with them what it costs to follow them."),
        (("capex", "infra"), "New plants and lines change supply and its cost."),
        (("earnings",), "Results move what markets expect."),
        (("market-demand",), "Demand moves plans and prices."),
        (("security",), "A risk to services and to those who answer for them."),
    )
    why_default: str = "It may change the direction of the field."
    why_missing: str = "The article gives no clear reason."
    rationale_low: str = "Little evidence, so of little weight."
    quality_low_reason: str = "too little information"
    #: Words of a title or summary beside which missing signals aren't accepted.
    alignment_triggers: tuple[str, ...] = ("license", "apache", "token", "tion the")
    rationale_default: str = "The summary shows no evidence of its weight."
    drop_texts: tuple[tuple[str, str], ...] = (("outdated", "too old"), ("stale_incident", "about an old incident"), ("low_quality", "too little information"))
    drop_default: str = "left out"
    quality_default: str = "informative"
    # dates near these words are of results, not of incidents
    result_words: tuple[str, ...] = ("quarter", "earnings")


DEFAULT = Config()
