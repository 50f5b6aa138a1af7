"""One query per operator or small family, over the whole tables, with the same rule as DuckDB SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.config import DEFAULT as CFG
from gazette.functions import signals as sg
from gazette.functions import text as tx
from gazette.functions import tokens as tk
from gazette.operators import aggregates, dedupe, filters, joins, judged, output, pages, selection, validation
from gazette.plans.articles import articles, derived, keyed, link, table
from gazette.sources import feeds, sinks
from gazette.streaming.recent import without_recent

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# SQL building blocks


def said(c: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w.lower()}')" for w in words) + ")" if words else "FALSE"


def case(c: str, pairs, default) -> str:
    return "CASE " + " ".join(f"WHEN {c.format(k)} THEN {v}" for k, v in pairs) + f" ELSE {default} END"


def listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def some(parts) -> str:
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


def label_case(label: str, words) -> str:
    cond = said("full_text", CFG.sanctions_words if label == "sanctions" else words)
    if label in ("policy", "market-demand"):
        cond = f"({cond} OR {said('full_text', CFG.trade_words)})"
    return f"CASE WHEN {cond} THEN '{label}' END"


ARTICLES = """WITH articles AS (
  SELECT d.doc_id AS item_id, coalesce(string_split(coalesce(d.text, ''), chr(10))[1], '') AS title, coalesce(string_split(coalesce(d.text, ''), chr(10))[2], '') AS summary,
         coalesce(d.text, '') AS full_text, d.source, d.lang, d.n_chars, e.event_type AS topic, e.ts AS published_at, e.value
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id)"""
WEIGHT = f"CASE WHEN lower(coalesce(source, '')) IN {tuple(CFG.tier_a)} THEN 3.0 WHEN lower(coalesce(source, '')) IN {tuple(CFG.tier_b)} THEN 1.5 ELSE 0.3 END"
BOOST = f"greatest(0.0, least(1.0, ({WEIGHT}::DOUBLE - 0.3) / 2.7)) * 0.6"
SHORT = "list_filter(signals, lambda x: NOT list_contains(longs, x))"
CONTEXT = f"(list_has_any(signals, {listed(CFG.structural_signals)}) OR {said('full_text', CFG.policy_action)} OR {said('full_text', CFG.structural)} OR (category IN ('policy', 'international') AND {said('full_text', CFG.government)}))"
LINK = "'https://' || source || '.example/' || CASE WHEN item_id % 17 = 0 THEN 'ads/' ELSE 'item/' END || item_id"
DERIVED = (
    ARTICLES
    + f""", step1 AS (
  SELECT *, {LINK} AS link, (epoch_us(TIMESTAMP '{CFG.run_ts}') - epoch_us(published_at)) / 3.6e9 AS age,
         {some(label_case(k, w) for k, w in CFG.signals)}[1:2] AS signals,
         {case("contains(lower(coalesce(topic, '')), '{}')", [(f, f"'{c}'") for f, c in CFG.categories], f"'{CFG.default_category}'")} AS category,
         greatest(10, least(40, (round_even(length(trim(full_text)) / 500.0::DOUBLE * 60 / 10, 0) * 10)::INT)) AS seconds
  FROM articles), step2 AS (
  SELECT *, list_filter(signals, lambda x: list_contains({some(f"CASE WHEN {said('full_text', w)} THEN '{k}' END" for k, w in CFG.long_triggers)}, x)) AS longs FROM step1),
  step3 AS (
  SELECT *, round((CASE WHEN len(longs) > 0 THEN 3.0 ELSE 0.0 END + CASE WHEN list_has_any({SHORT}, ['capex', 'infra', 'security']) THEN 2.0 ELSE 0.0 END
    + CASE WHEN list_has_any({SHORT}, ['policy', 'sanctions']) THEN 1.0 ELSE 0.0 END + CASE WHEN list_has_any(signals, ['earnings', 'market-demand']) THEN 1.0 ELSE 0.0 END
    + CASE WHEN seconds <= 20 THEN 0.5 ELSE 0.0 END)::DOUBLE + {BOOST}, 6) AS score FROM step2),
  derived AS (
  SELECT *, CASE WHEN {said('full_text', CFG.hard_exclude)} THEN 'hard_exclude_keyword' WHEN {said('link', CFG.hard_urls)} THEN 'hard_exclude_url_hint' WHEN {said('full_text', CFG.local_promo)} THEN 'local_promo'
    WHEN {said('full_text', CFG.exclude)} AND NOT {CONTEXT} THEN 'exclude_keyword'
    WHEN {said('full_text', CFG.actors)} AND {said('full_text', CFG.commentary)} AND NOT {said('full_text', CFG.policy_action)} THEN 'political_commentary'
    WHEN NOT {CONTEXT} AND len(signals) = 0 THEN 'no_structural_signal'
    WHEN NOT (CASE WHEN age IS NULL THEN TRUE WHEN age > {CFG.stale_hours} THEN FALSE WHEN age > {CFG.fresh_hours} THEN len(longs) > 0 ELSE TRUE END) THEN 'freshness'
    WHEN {said('full_text', CFG.emotional)} AND NOT {CONTEXT} THEN 'emotional_filter' END AS reason FROM step3)"""
)
TOKENS = "list_filter(string_split_regex(regexp_replace(lower(title), '[^a-z0-9가-힣]', ' ', 'g'), '\\s+'), lambda x: x <> '')"



def tokens_of(c: str) -> str:
    return TOKENS.replace("lower(title)", f"lower({c})")


def first_of_kind(c: str) -> str:
    """An array column without repeats, in its order."""
    return f"list_filter({c}, lambda x, i: list_position({c}, x) = i)"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")" if words else "('')"


_NORMAL = "CASE t " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CFG.aliases) + " ELSE t END"
for _ in range(3):
    _NORMAL = f"regexp_replace({_NORMAL}, '^(.{{2,}}?)(?:{'|'.join(sorted(CFG.endings, key=len, reverse=True))})$', '\\1')"
_VALID = "length({0}) >= CASE WHEN regexp_matches({0}, '[가-힣]') THEN 2 ELSE 3 END"
_DATE = "regexp_matches({0}, '^(?:19|20)[0-9]{{2}}$|^2100$|^[0-9]+(?:년|월|일|분기|q)$|^[1-4]q$|^q[1-4]$')"
_NOISE = f"({{0}} IN {_in((*CFG.stopwords, *CFG.noise_words))} OR regexp_matches({{0}}, '^[0-9]+$|^.$') OR regexp_matches({{0}}, '(?:{'|'.join(CFG.media_suffixes)})$'))"
_NAMES = sorted({w for v in (CFG.event_labels, CFG.domain_labels, CFG.relations) for _, ws in v for w in ws} | set(CFG.actions))


def normal_list(c: str) -> str:
    return f"list_filter(list_transform({c}, lambda t: {_NORMAL}), lambda x: x NOT IN {_in(CFG.stopwords)} AND {_VALID.format('x')})"


def _said_of(c: str, ws) -> str:
    return "(" + " + ".join(f"list_contains({c}, '{w}')::INT" for w in ws) + ")"


def cluster_steps(src: str, own: str, hint: str, name: str) -> str:
    """Two steps that give the column `name`: the cluster key of the tokens own under the hint's tokens."""
    events = some(f"CASE WHEN {_said_of('tk', ws)} >= 1 THEN '{label}' END" for label, ws in CFG.event_labels)
    domains = some(f"CASE WHEN {_said_of('tk', ws)} >= 2 THEN '{label}' END" for label, ws in CFG.domain_labels)
    relations = ", ".join(f"{{'n': -{_said_of('tk', ws)}, 'l': {-len(label)}, 'label': '{label}'}}" for label, ws in CFG.relations)
    return f"""{name}_1 AS (SELECT *, CASE WHEN len({hint}) > 0 THEN {hint} ELSE {own} END AS tk, list_filter({own}, lambda x: NOT {_NOISE.format('x')} AND NOT {_DATE.format('x')} AND {_VALID.format('x')} AND x NOT IN {_in(_NAMES)}) AS names FROM {src}),
 {name}_2 AS (SELECT *, {events} AS ev, {domains} AS dm, list_sort(list_filter([{relations}], lambda x: x.n < 0))[1].label AS rel FROM {name}_1),
 {name}_3 AS (SELECT *, list_concat(list_filter([coalesce(rel || '_' || ev[1], ev[1], rel)], lambda x: x IS NOT NULL), dm[1:1], names[1:1], ev[2:10], dm[2:10], CASE WHEN len(names) > 0 AND (len(ev) > 0 OR len(dm) > 0) THEN [] ELSE names END) AS whole FROM {name}_2),
 {name}_4 AS (SELECT * EXCLUDE (tk, names, ev, dm, rel, whole), array_to_string(({first_of_kind('whole')})[1:4], '/') AS {name} FROM {name}_3)"""


_WORTH = f"(list_contains(ta, t)::INT * 3 + regexp_matches(t, '(?:{'|'.join(CFG.org_suffixes)})$')::INT * 2 + regexp_matches(t, '[0-9]')::INT * 2 + (length(t) >= 6)::INT)"
KEYED = f"""{DERIVED}, k0 AS (SELECT item_id, title, summary, score, source, published_at, {tokens_of('title')} AS rt, {tokens_of('summary')} AS rs FROM derived),
 k1 AS (SELECT *, {normal_list('rt')} AS a, {normal_list('rs')} AS b, list_concat(rt, rs) AS r FROM k0),
 k2 AS (SELECT * EXCLUDE (a, b, r), {first_of_kind('a')} AS ta, {first_of_kind('b')} AS sa, {first_of_kind('r')} AS raw, {first_of_kind('rt')} AS hint FROM k1),
 k3 AS (SELECT *, list_filter(list_concat(ta, list_filter(sa, lambda x: NOT list_contains(ta, x))), lambda x: NOT {_DATE.format('x')} AND x NOT IN {_in([w for _, ws in CFG.event_labels for w in ws] + list(CFG.actions))}) AS loose FROM k2),
 k4 AS (SELECT *, CASE WHEN len(list_filter(loose, lambda x: NOT {_NOISE.format('x')})) >= 4 THEN list_filter(loose, lambda x: NOT {_NOISE.format('x')}) ELSE loose END AS pick FROM k3),
 k5 AS (SELECT *, list_transform(list_sort(list_transform(pick, lambda t, i: {{'w': -{_WORTH}, 'i': i, 'l': -length(t), 't': t}}))[1:8], lambda x: x.t) AS best FROM k4),
 k6 AS (SELECT *, coalesce(nullif(array_to_string(list_sort(CASE WHEN len(best) >= 4 THEN best ELSE list_concat(best, list_filter(raw, lambda x: NOT list_contains(best, x)))[1:4] END), '-'), ''), 'news') AS dedupe_key FROM k5),
 k7 AS (SELECT *, list_filter(string_split(dedupe_key, '-'), lambda x: x <> '') AS own FROM k6),
 {cluster_steps('k7', 'own', 'hint', 'cluster_key')},
 keyed AS (SELECT * FROM cluster_key_4)"""
_JUDGED = f"""j1 AS (SELECT *, list_filter(own, lambda x: NOT {_DATE.format('x')} AND x NOT IN {_in(label for label, _ in CFG.event_labels)}) AS jl FROM keyed),
 j2 AS (SELECT *, list_filter(jl, lambda x: NOT {_NOISE.format('x')} AND {_VALID.format('x')})[1:8] AS js FROM j1),
 j3 AS (SELECT *, coalesce(nullif(array_to_string(CASE WHEN len(js) >= 4 THEN js ELSE list_concat(js, list_filter(jl, lambda x: NOT list_contains(js, x)))[1:4] END, '-'), ''), dedupe_key) AS judged_key FROM j2)"""


def jaccard_sql(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) + len({b}) > 0 THEN len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE ELSE 0 END)"


def grams_sql(key: str) -> str:
    flat = f"regexp_replace({key}, '[- ]', '', 'g')"
    return f"(CASE WHEN length({flat}) >= 2 THEN list_distinct(list_transform(range(1, length({flat})), lambda i: substr({flat}, i, 2))) ELSE [] END)"


def greedy_sql(rows: str, edges: str) -> str:
    """Steps that end in walked(item_id, hit): rows(item_id, score) in rank order, each merged into the earliest kept one that edges(lo, hi) joins it with."""
    return f"""line AS (SELECT item_id, row_number() OVER (ORDER BY -score, item_id) AS n FROM {rows}),
 above AS MATERIALIZED (SELECT l.n, l.item_id, coalesce(list(h.item_id ORDER BY h.n) FILTER (h.item_id IS NOT NULL), []) AS his FROM line l LEFT JOIN {edges} e ON e.lo = l.item_id LEFT JOIN line h ON h.item_id = e.hi AND h.n < l.n GROUP BY 1, 2),
 walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS kept, NULL::BIGINT AS item_id, NULL::BIGINT AS hit
  UNION ALL SELECT a.n, CASE WHEN len(list_filter(a.his, lambda x: list_contains(w.kept, x))) = 0 THEN list_append(w.kept, a.item_id) ELSE w.kept END, a.item_id, list_filter(a.his, lambda x: list_contains(w.kept, x))[1] FROM walk w JOIN above a ON a.n = w.n + 1),
 walked AS (SELECT item_id, hit FROM walk WHERE n > 0)"""


def recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql.removeprefix("WITH")


CLUSTERED = f"""{KEYED}, c1 AS (SELECT *, first_value(item_id) OVER w AS first, first_value(ta) OVER w AS ta2, first_value(dedupe_key) OVER w AS key2 FROM keyed WINDOW w AS (PARTITION BY cluster_key ORDER BY -score, item_id)),
 c2 AS (SELECT item_id, first, len(list_filter(string_split_regex(cluster_key, '[/_-]'), lambda x: x <> '')) >= 2 AND item_id <> first AND {jaccard_sql('ta', 'ta2')} >= {max(0.3, CFG.title_threshold)} AND {jaccard_sql(grams_sql('dedupe_key'), grams_sql('key2'))} >= {max(0.3, CFG.key_threshold)} AS hit FROM c1),
 clustered AS (SELECT item_id, CASE WHEN hit THEN 'merged' ELSE 'kept' END AS status, CASE WHEN hit THEN 'cluster_duplicate' END AS merge_reason, CASE WHEN hit THEN first END AS matched_to FROM c2)"""
PREFIXED = """p1 AS (SELECT item_id, array_to_string(own[1:3], '-') AS prefix, score FROM keyed), p2 AS (SELECT *, first_value(item_id) OVER (PARTITION BY prefix ORDER BY -score, item_id) AS first FROM p1),
 prefixed AS (SELECT item_id, CASE WHEN prefix <> '' AND item_id <> first THEN first END AS matched_to FROM p2)"""

# flagship and row-local columns


@query(f"""{DERIVED}, ranked AS (SELECT item_id, topic, score, row_number() OVER (PARTITION BY topic ORDER BY score DESC, item_id) AS topic_rank FROM derived WHERE reason IS NULL AND score >= 0)
SELECT item_id, topic, score, topic_rank FROM ranked WHERE topic_rank <= CASE WHEN topic = 'click' THEN 15 WHEN topic IS NULL OR topic = 'error' THEN 3 ELSE 12 END""")
def topic_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-1, SRC-2, FLT-1, FLT-8: each topic's best admissible articles."""
    df = derived(spark, sf_dir).where(F.col("reason").isNull() & (F.col("score") >= CFG.min_score))
    feeds_ = table(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), F.when(F.col("event_type") == "click", 15).when(F.col("event_type") != "error", 12).alias("limit"))
    return selection.per_topic_top(df, selection.topic_limits(feeds_, CFG.default_topic_limit), most=15).select("item_id", "topic", "score", F.col("topic_rank").cast("long").alias("topic_rank"))


@query(f"{DERIVED} SELECT item_id, array_to_string(signals, ',') AS signals, array_to_string(longs, ',') AS longs, seconds, category, score, round(age, 6) AS age, link FROM derived")
def article_scores(spark, sf_dir):
    """SIG-1, SIG-2, SCR-1, SCR-2, PRJ-10, PRJ-11, PRJ-16."""
    return derived(spark, sf_dir).select("item_id", F.array_join("signals", ",").alias("signals"), F.array_join("longs", ",").alias("longs"), "seconds", "category", "score", F.round("age", 6).alias("age"), "link")


@query(f"{DERIVED} SELECT topic AS feed_id, coalesce(reason, 'candidate') AS outcome, count(*) AS n, GROUPING(topic, coalesce(reason, 'candidate'))::INT AS level FROM derived GROUP BY GROUPING SETS ((topic, coalesce(reason, 'candidate')), (topic), ())")
def ingest_metrics(spark, sf_dir):
    """AGG-1: outcomes per feed, per feed and in all, in one pass."""
    return aggregates.ingest_metrics(derived(spark, sf_dir).select(F.col("topic").alias("feed_id"), F.coalesce("reason", F.lit("candidate")).alias("outcome")))


@query(f"""{DERIVED} SELECT item_id, {CONTEXT} AS structural, {said('full_text', CFG.actors)} AND {said('full_text', CFG.commentary)} AND NOT {said('full_text', CFG.policy_action)} AS commentary,
 CASE WHEN age IS NULL THEN TRUE WHEN age > {CFG.stale_hours} THEN FALSE WHEN age > {CFG.fresh_hours} THEN len(longs) > 0 ELSE TRUE END AS fresh,
 CASE WHEN age IS NULL THEN TRUE WHEN age <= {CFG.top_fresh_hours} THEN TRUE ELSE len(longs) > 0 AND age <= {CFG.stale_hours} END AS top_fresh,
 {said("coalesce(source, '')", CFG.top_sources)} AS allowed, {said('link', CFG.hard_urls)} AS url_hint, {said("title || ' ' || summary", CFG.incident_words)} AS incident FROM derived""")
def predicates(spark, sf_dir):
    """FLT-2, FLT-3, FLT-5, FLT-6, FLT-7, FLT-10, FLT-18."""
    t, s = F.col("full_text"), F.col("signals")
    return derived(spark, sf_dir).select(
        "item_id", filters.structural(t, s, F.col("category"), CFG).alias("structural"), filters.political_commentary(t, CFG).alias("commentary"), filters.fresh(F.col("age"), F.col("longs"), CFG).alias("fresh"),
        filters.top_fresh(F.col("age"), F.col("longs"), CFG).alias("top_fresh"), filters.source_allowed(F.col("source"), CFG).alias("allowed"), filters.url_dropped(F.col("link"), CFG).alias("url_hint"), filters.simple_incident(F.col("title"), F.col("summary"), CFG).alias("incident"),
    )


@query(f"""{ARTICLES}, flat AS (SELECT *, trim(regexp_replace(full_text, '\\s+', ' ', 'g')) AS body FROM articles)
SELECT item_id, length(body)::INT AS n_collapsed, len(list_filter(string_split(regexp_replace(body, '([.!?。])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> ''))::INT AS n_sentences,
 substr(sha1(trim(regexp_replace(concat_ws(' ', title, summary), '\\s+', ' ', 'g'))), 1, 12) AS input_hash, CASE WHEN lower(summary) <> lower(title) THEN summary ELSE '' END AS summary_source FROM flat""")
def text_shape(spark, sf_dir):
    """PRJ-2, PRJ-13, PRJ-15, PRJ-22."""
    body = tx.collapse(F.col("full_text"))
    return articles(spark, sf_dir).select("item_id", F.length(body).alias("n_collapsed"), F.size(tx.sentences(body)).alias("n_sentences"), tx.input_hash(F.col("title"), F.col("summary")).alias("input_hash"), tx.summary_source(F.col("title"), F.col("summary")).alias("summary_source"))


@query()
def summary_lines(spark, sf_dir):
    """PRJ-1, PRJ-3, PRJ-4, PRJ-5, PRJ-6, PRJ-12, PRJ-14 over whole texts (tests hold the rules)."""
    df = articles(spark, sf_dir)
    return df.select("item_id", tx.trim_title(tx.clean_text(F.col("title")), F.col("source"), CFG).alias("title"), tx.strip_source(tx.clean_text(F.col("summary")), F.col("source")).alias("summary"), tx.summary_lines(tx.sanitize(F.col("full_text")), CFG).alias("lines"))


@query(f"""SELECT source, count(*) AS n, {WEIGHT}::DOUBLE AS weight, round({BOOST}, 6) AS boost, {said("coalesce(source, '')", CFG.top_sources)} AS allowed FROM documents GROUP BY source""")
def source_tiers(spark, sf_dir):
    """JON-2, SCR-2, FLT-7, PRJ-7."""
    df = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    w = sg.source_weight(F.col("source"), CFG)
    return df.select("source", "n", w.alias("weight"), F.round(sg.source_boost(w), 6).alias("boost"), filters.source_allowed(F.col("source"), CFG).alias("allowed"))


@query(f"SELECT source, count(*) AS n FROM documents WHERE NOT {said('source', CFG.top_sources)} GROUP BY source ORDER BY n DESC, source LIMIT 10")
def allowlist_misses(spark, sf_dir):
    """AGG-4 (a top-k report)."""
    return aggregates.allowlist_misses(table(spark, sf_dir, "documents").select("source", filters.source_allowed(F.col("source"), CFG).alias("allowed")))


# scans and numbering


@query("SELECT doc_id AS item_id, source AS feed_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 150")
def feed_cap(spark, sf_dir):
    """SRC-3: the first 150 entries of each feed."""
    df = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.col("source").alias("feed_id"), F.col("doc_id").alias("pos"))
    return selection.per_feed_cap(df, CFG.feed_cap).select("item_id", "feed_id")


FEED_KINDS = """k0 AS (SELECT source AS feed_id, coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT), 0) AS k, doc_id, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents WHERE source IS NOT NULL),
 k1 AS (SELECT *, k % 5 = 1 AS cut, k % 5 = 2 AS gone FROM k0 WHERE place <= 150), k2 AS (SELECT * FROM k1 WHERE NOT gone AND (NOT cut OR place <= 3))"""


def _land(spark, sf_dir) -> tuple[str, str]:
    """Feeds as files, a source each, of 150 entries at most: RSS for odd numbers, lines of JSON for even ones. Some break off after three entries, some hold none."""
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL").select("source", "doc_id", "lang")
    docs = selection.per_feed_cap(docs.select("*", F.col("source").alias("feed_id"), F.col("doc_id").alias("pos")), CFG.feed_cap)
    k = F.coalesce(F.nullif(F.regexp_extract("source", "([0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    at = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    docs = docs.select(F.col("source").alias("feed"), k.alias("k"), at.alias("at"), "doc_id", "lang", "source").where((F.col("k") % 5 != 1) | (F.col("at") < 3))
    d = F.col("doc_id").cast("string")
    item = F.concat(F.lit("<item><title>No. &lt;"), d, F.lit("&gt; &amp; more</title><description>"), F.col("lang"), F.lit('</description><source url="u"> '), F.col("source"), F.lit("</source></item>"))
    whole = docs.groupBy("feed", "k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", item.alias("x")))), lambda e: e["x"]), "").alias("items"))  # 150 entries at most
    rss = F.when(F.col("k") % 5 == 2, "<html>no feed today").when(F.col("k") % 5 == 1, F.concat(F.lit("<rss><channel>"), "items", F.lit("<item><title>cut of"))).otherwise(F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")))
    lines = docs.where("k % 5 <> 2").select("feed", "k", F.to_json(F.struct(F.col("at").alias("pos"), F.concat(F.lit("No. <"), d, F.lit("> & more")).alias("title"), F.col("lang").alias("summary"), F.struct(F.col("source").alias("title")).alias("source"))).alias("value"))
    broken = docs.where("k % 5 IN (1, 2)").select("feed", "k").distinct().select("feed", "k", F.lit('{"pos": 9, "ti').alias("value"))
    xml, js = _folder(spark), _folder(spark)
    whole.where("k % 2 = 1").select("feed", rss.alias("value")).write.partitionBy("feed").text(xml)
    lines.unionByName(broken).where("k % 2 = 0").select("feed", "value").write.partitionBy("feed").text(js)
    return xml, js


@query(f"""WITH {FEED_KINDS} SELECT feed_id, (place - 1)::INT AS pos, 'No. <' || doc_id || '> & more' AS title, lang AS summary, feed_id AS source FROM k2""")
def feed_entries(spark, sf_dir):
    """SRC-1, SET-1, SRC-3, PRJ-7: entries of feeds in two formats as one table, as far as each file can be read."""
    xml, js = _land(spark, sf_dir)
    rows = feeds.union_feeds(feeds.landed_xml(spark, xml), feeds.landed_json(spark, js)).where("NOT corrupt")
    return rows.select("feed_id", F.col("pos").cast("int").alias("pos"), "title", "summary", "source")


@query(f"""WITH {FEED_KINDS}, n AS (SELECT feed_id, count(*) AS entries FROM k2 GROUP BY 1), a AS (SELECT feed_id, bool_or(cut OR gone) AS broken FROM k1 GROUP BY 1)
SELECT feed_id, coalesce(entries, 0) AS entries, CASE WHEN broken AND coalesce(entries, 0) = 0 THEN 'failure' WHEN broken THEN 'warning' ELSE 'ok' END AS state FROM a LEFT JOIN n USING (feed_id)""")
def feed_health(spark, sf_dir):
    """SRC-4: broken files with and without entries, found by reading them."""
    xml, js = _land(spark, sf_dir)
    return aggregates.feed_health(feeds.union_feeds(feeds.landed_xml(spark, xml), feeds.landed_json(spark, js)))


@query("SELECT doc_id AS item_id, 'item_' || row_number() OVER (ORDER BY source, doc_id) AS running_id FROM documents")
def running_ids(spark, sf_dir):
    """PRJ-23: a running number over all feeds, by offsets."""
    return selection.running_ids(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.col("source").alias("feed_ord"), F.col("doc_id").alias("pos"))).select("item_id", "running_id")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS rfc FROM events""")
def parsed_times(spark, sf_dir):
    """PRJ-9: ISO and RFC-2822 strings of the same times parse alike."""
    df = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("a"), F.concat(F.date_format("ts", "EEE"), F.lit(", "), F.date_format("ts", "d MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("b"))
    show = lambda c: F.date_format(tx.parse_timestamp(F.col(c)), "yyyy-MM-dd HH:mm:ss")
    return df.select("event_id", show("a").alias("iso"), show("b").alias("rfc"))


# tokens and keys


@query(f"""{ARTICLES}, t AS (SELECT item_id, unnest(list_distinct({TOKENS})) AS token FROM articles)
SELECT token, count(*) AS df, (length(token) >= CASE WHEN regexp_matches(token, '[가-힣]') THEN 2 ELSE 3 END) AS valid, regexp_matches(token, '^(?:19|20)[0-9]{{2}}$|^2100$|^[0-9]+(?:년|월|일|분기|q)$|^[1-4]q$|^q[1-4]$') AS date_like, regexp_matches(token, '(?:{"|".join(CFG.org_suffixes)})$') AS org_like FROM t GROUP BY token""")
def token_profile(spark, sf_dir):
    """TOK-1, TOK-3: distinct title tokens with document frequency and classes."""
    t = articles(spark, sf_dir).select(F.explode(F.array_distinct(tk.raw_tokens(F.col("title")))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return t.select("token", "df", tk.valid_length(F.col("token")).alias("valid"), tk.is_date_like(F.col("token")).alias("date_like"), tk.is_org_like(F.col("token"), CFG).alias("org_like"))


@query(f"""{ARTICLES}, k AS (SELECT item_id, array_to_string({TOKENS}, '') AS flat FROM articles)
SELECT item_id, CASE WHEN length(flat) >= 2 THEN len(list_distinct(list_transform(range(1, length(flat)), lambda i: substr(flat, i, 2))))::INT ELSE 0 END AS n_grams FROM k""")
def key_ngrams(spark, sf_dir):
    """KEY-3 over the titles' joined tokens."""
    return articles(spark, sf_dir).select("item_id", F.size(tk.key_ngrams(F.array_join(tk.raw_tokens(F.col("title")), "-"))).alias("n_grams"))


@query(f"{KEYED}, {_JUDGED} SELECT item_id, dedupe_key, cluster_key, judged_key, array_to_string(ta, ' ') AS title_tokens FROM j3")
def article_keys(spark, sf_dir):
    """TOK-2, KEY-1, KEY-2, PRJ-19."""
    return keyed(spark, sf_dir, scored=False, only=("cluster_key",)).select("item_id", "dedupe_key", "cluster_key", tk.judged_key(F.col("dedupe_key"), CFG).alias("judged_key"), F.array_join(tk.normal_tokens(F.col("title"), CFG), " ").alias("title_tokens"))


# joins


@query(f"""{DERIVED}, h AS (SELECT lower(title) AS k, max_by(item_id, (published_at, item_id)) AS matched_to FROM derived WHERE published_at < TIMESTAMP '2024-01-02 00:00:00' AND title <> '' GROUP BY 1)
SELECT d.item_id, h.matched_to FROM derived d LEFT JOIN h ON lower(d.title) = h.k WHERE d.published_at >= TIMESTAMP '2024-01-02 00:00:00'""")
def history_lookup(spark, sf_dir):
    """SRC-5, JON-1: matches with the days before, one row per key."""
    df = derived(spark, sf_dir).withColumn("cluster_key", F.lower("title")).withColumn("date", F.to_date("published_at"))
    split = F.lit("2024-01-02").cast("timestamp")
    old = df.where((F.col("published_at") < split) & (F.col("title") != ""))
    history = old.groupBy("cluster_key").agg(F.max_by("item_id", F.struct("published_at", "item_id")).alias("item_id"))
    return joins.history_lookup(df.where(F.col("published_at") >= split), history).select("item_id", "matched_to")


@query(f"""{DERIVED}, p AS (SELECT page_id, url, length(html) AS body FROM pages), lack AS (SELECT p.url AS link, max(d.score) AS s FROM derived d JOIN p ON p.page_id = d.item_id WHERE d.n_chars < 300 GROUP BY 1 ORDER BY s DESC, link LIMIT 200)
SELECT d.item_id, CASE WHEN d.n_chars < 300 AND l.link IS NOT NULL THEN p.body ELSE length(d.full_text) END::INT AS n FROM derived d JOIN p ON p.page_id = d.item_id LEFT JOIN lack l ON l.link = p.url""")
def body_join(spark, sf_dir):
    """JON-3: bodies for the best short rows, each link once, within the budget."""
    p = table(spark, sf_dir, "pages")
    df = derived(spark, sf_dir).drop("link").join(p.select(F.col("page_id").alias("item_id"), F.col("url").alias("link")), "item_id")
    return joins.body_join(df, p.select("url", F.col("html").alias("body"))).select("item_id", F.length("full_text").alias("n"))


@query(f"""{DERIVED} SELECT d.item_id, greatest(0.0, d.score + (coalesce(CASE WHEN l.quality = 1 THEN 4 WHEN l.quality = 0 THEN 1 END, 3) - 3)) AS score, CASE WHEN l.quality = 0 THEN 'low_quality' END AS drop_reason,
 CASE WHEN l.quality = 0 THEN 1 ELSE 4 END AS importance FROM derived d LEFT JOIN labels l ON l.doc_id = d.item_id""")
def judgment_join(spark, sf_dir):
    """JON-4, SCR-3, FLT-15: judged quality adjusts the score."""
    j = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), "quality")
    df = derived(spark, sf_dir).join(j, "item_id", "left")
    q = F.when(F.col("quality") == 0, "low_quality").otherwise("ok")
    reason, _ = filters.low_quality(q, F.lit(4), "drop")
    _, importance = filters.low_quality(q, F.lit(4), "downgrade")
    judged = F.when(F.col("quality") == 1, 4).when(F.col("quality") == 0, 1)
    return df.select("item_id", sg.judged_score(F.col("score"), judged).alias("score"), reason.alias("drop_reason"), importance.alias("importance"))


@query(f"""{DERIVED}, s AS (SELECT item_id, item_id AS pos, CASE WHEN item_id % 3 = 0 THEN 'merged' ELSE 'kept' END AS status, source || topic AS cluster_key FROM derived),
 f AS (SELECT cluster_key, min(item_id) AS first FROM s WHERE status = 'kept' GROUP BY 1)
SELECT s.item_id, CASE WHEN status = 'merged' THEN first END AS matched_to FROM s LEFT JOIN f USING (cluster_key)""")
def cluster_first(spark, sf_dir):
    """JON-5."""
    df = derived(spark, sf_dir).select("item_id", F.col("item_id").alias("pos"), F.when(F.col("item_id") % 3 == 0, "merged").otherwise("kept").alias("status"), F.concat("source", "topic").alias("cluster_key"), F.lit(None).cast("long").alias("matched_to"))
    return joins.cluster_first(df).select("item_id", "matched_to")


@query(f"""{DERIVED}, r AS (SELECT item_id, score, source || topic AS cluster_key, left(title, 6) AS key_prefix FROM derived), top AS (SELECT * FROM r ORDER BY score DESC, item_id LIMIT 32),
 more AS (SELECT * FROM r WHERE item_id NOT IN (SELECT item_id FROM top) AND (cluster_key IN (SELECT cluster_key FROM top) OR (key_prefix <> '' AND key_prefix IN (SELECT key_prefix FROM top))) ORDER BY score DESC, item_id LIMIT 16)
SELECT item_id, score FROM top UNION ALL SELECT item_id, score FROM more""")
def semantic_candidates(spark, sf_dir):
    """TOP-6, JON-6, SET-2 (a top-k report)."""
    df = derived(spark, sf_dir, reasons=False).select("item_id", "score", F.concat("source", "topic").alias("cluster_key"), F.substring("title", 1, 6).alias("key_prefix"))
    return selection.semantic_candidates(dedupe.stored(df), CFG).select("item_id", "score")


@query(f"""{ARTICLES}, m AS (SELECT item_id, list_sort(list_distinct({TOKENS})) AS t, min(item_id) OVER (PARTITION BY list_sort(list_distinct({TOKENS}))) AS first FROM articles WHERE len({TOKENS}) > 0),
 s AS (SELECT item_id, t FROM m WHERE item_id = first), e AS (SELECT item_id, len(t) AS n, unnest(t) AS w FROM s),
 p AS (SELECT a.item_id AS hi, b.item_id AS lo, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM e a JOIN e b ON a.w = b.w AND a.item_id < b.item_id GROUP BY 1, 2)
SELECT lo, hi, round(k / (na + nb - k)::DOUBLE, 6) AS similarity FROM p WHERE k / (na + nb - k)::DOUBLE >= 0.55
UNION ALL SELECT item_id, first, 1.0 FROM m WHERE item_id <> first""")
def title_similarity(spark, sf_dir):
    """JON-8: pairs of different titles with token Jaccard of 0.55 or more, and each copy with the first of its kind."""
    sets = articles(spark, sf_dir).select(F.col("item_id").alias("id"), F.col("item_id").alias("rank"), tk.raw_tokens(F.col("title")).alias("tokens"))
    pairs = joins.set_similarity_join(sets, CFG.title_threshold).select("lo", "hi", F.round("similarity", 6).alias("similarity"))
    copies = joins.equal_sets(sets).where("id <> first").select(F.col("id").alias("lo"), F.col("first").alias("hi"), F.lit(1.0).alias("similarity"))
    return pairs.unionByName(copies)


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v WHERE list_dot_product(e, e) > 0)
SELECT q.vec_id AS query, u.vec_id AS id, round(list_dot_product(q.e, u.e), 6) AS cosine FROM u JOIN u q ON q.vec_id % 50 = 0 AND q.vec_id <> u.vec_id WHERE list_dot_product(q.e, u.e) >= 0.35""")
def cosine_pairs(spark, sf_dir):
    """JON-9: every vector whose id is divisible by 50, against all."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return joins.cosine_join(v, v.where("id % 50 = 0"), 0.35).select("query", "id", F.round("cosine", 6).alias("cosine"))


@query(f"""{ARTICLES}, s AS (SELECT item_id, list_distinct({TOKENS}) AS a, list_distinct(list_filter(string_split_regex(regexp_replace(lower(summary), '[^a-z0-9가-힣]', ' ', 'g'), '\\s+'), lambda x: x <> '')) AS b FROM articles)
SELECT item_id, len(list_intersect(a, b))::INT AS n_both, len(list_distinct(list_concat(a, b)))::INT AS n_union, len(list_filter(a, lambda x: NOT list_contains(b, x)))::INT AS n_only_a,
 len(list_filter(a, lambda x: NOT list_contains(b, x))) = 0 AS a_in_b, round(CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / least(len(a), len(b))::DOUBLE ELSE 0 END, 6) AS overlap FROM s""")
def pair_overlap(spark, sf_dir):
    """SET-3: title against summary."""
    df = articles(spark, sf_dir).select("item_id", F.array_distinct(tk.raw_tokens(F.col("title"))).alias("a"), F.array_distinct(tk.raw_tokens(F.col("summary"))).alias("b"))
    return joins.pair_overlap(df).drop("a", "b").withColumn("overlap", F.round("overlap", 6))


# duplicate passes


def _merged(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").alias("item_id"), "status", "merge_reason", "matched_to")


@query(recursive(f"""{KEYED}, words AS (SELECT item_id, score, len(ta) AS n, unnest(ta) AS w FROM keyed), shared AS (SELECT a.item_id AS lo, b.item_id AS hi, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM words a JOIN words b ON a.w = b.w AND a.item_id <> b.item_id GROUP BY 1, 2),
 near AS (SELECT lo, hi FROM shared WHERE k / (na + nb - k)::DOUBLE >= {CFG.title_threshold}), {greedy_sql('keyed', 'near')},
 exact AS (SELECT k.item_id, first_value(k.item_id) OVER (PARTITION BY title ORDER BY -score, k.item_id) AS first FROM keyed k JOIN walked w ON w.item_id = k.item_id AND w.hit IS NULL WHERE title <> ''),
 done AS (SELECT w.item_id, coalesce(w.hit, CASE WHEN e.first <> e.item_id THEN e.first END) AS matched_to FROM walked w LEFT JOIN exact e ON e.item_id = w.item_id)
SELECT item_id, CASE WHEN matched_to IS NULL THEN 'kept' ELSE 'merged' END AS status, CASE WHEN matched_to IS NOT NULL THEN 'title_duplicate' END AS merge_reason, matched_to FROM done"""))
def title_duplicates(spark, sf_dir):
    """DED-1 (resolver and pass are tested against a sequential walk)."""
    return _merged(dedupe.title_duplicates(dedupe.stored(derived(spark, sf_dir, reasons=False).select(F.col("item_id").alias("id"), (-F.col("score")).alias("rank"), "title")), CFG))


@query(f"{CLUSTERED} SELECT * FROM clustered")
def cluster_duplicates(spark, sf_dir):
    """DED-2."""
    return _merged(dedupe.cluster_duplicates(dedupe.stored(keyed(spark, sf_dir, only=("cluster_key",)).select("id", "rank", "title", "dedupe_key", "cluster_key")), CFG))


@query(recursive(f"""{KEYED}, told AS (SELECT item_id, score, list_concat(rt, rs) AS tk, {first_of_kind('own')} AS ow FROM keyed),
 named AS (SELECT *, list_filter(ow, lambda x: NOT {_NOISE.format('x')} AND NOT {_DATE.format('x')} AND {_VALID.format('x')} AND x NOT IN {_in(_NAMES)})[1:8] AS names, {some(f"CASE WHEN {_said_of('tk', ws)} >= 1 THEN '{label}' END" for label, ws in CFG.event_labels)} AS ev, list_filter(tk, lambda x: x IN {_in(CFG.actions)})[1] AS action FROM told),
 may AS (SELECT * FROM named WHERE len(names) > 0 AND len(ev) > 0),
 met AS (SELECT a.item_id AS lo, b.item_id AS hi, list_filter(a.names, lambda x: list_contains(b.names, x)) AS both_, coalesce(a.action = b.action AND a.names[1] = b.names[1], FALSE) AS same, list_has_any(a.ev, b.ev) AS event FROM may a JOIN may b ON a.item_id <> b.item_id),
 near AS (SELECT lo, hi FROM met WHERE same OR (event AND (len(both_) >= 2 OR len(list_filter(both_, lambda x: regexp_matches(x, '(?:{'|'.join(CFG.org_suffixes)})$') OR regexp_matches(x, '^[가-힣]{{3,}}$') OR regexp_matches(x, '^[a-z0-9]{{5,}}$'))) > 0))), {greedy_sql('keyed', 'near')}
SELECT item_id, CASE WHEN hit IS NULL THEN 'kept' ELSE 'merged' END AS status, CASE WHEN hit IS NOT NULL THEN 'entity_event' END AS merge_reason, hit AS matched_to FROM walked"""))
def entity_events(spark, sf_dir):
    """DED-3."""
    return _merged(dedupe.entity_events(dedupe.stored(keyed(spark, sf_dir, only=("entities", "events", "action")).select("id", "rank", "entities", "events", "action")), CFG))


@query(f"{KEYED}, {PREFIXED} SELECT * FROM prefixed")
def key_prefixes(spark, sf_dir):
    """DED-5."""
    return dedupe.key_prefixes(dedupe.stored(keyed(spark, sf_dir, only=()).select("id", "rank", "dedupe_key"))).select(F.col("id").alias("item_id"), "matched_to")


@query()
def semantic_duplicates(spark, sf_dir):
    """DED-6, DED-7: the candidates of TOP-6, the strict pass, then the relaxed one."""
    rows = dedupe.stored(keyed(spark, sf_dir, only=("cluster_key", "key_prefix")).select("item_id", "score", "cluster_key", "key_prefix"))
    best = dedupe.stored(selection.semantic_candidates(rows, CFG).select("item_id"))
    chosen = keyed(spark, sf_dir, among=best)  # at most 48 rows
    words = F.array_distinct(F.filter(tk.raw_tokens(F.concat_ws(" ", "title", "summary")), tk.valid_length))
    some_rows = dedupe.stored(chosen.select("id", "rank", "cluster_key", "key_prefix", words.alias("words"), dedupe.informs(F.col("title"), F.col("summary"), F.col("full_text"), CFG).alias("told")))
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")).join(some_rows.select("id"), "id", "left_semi")
    ranks = some_rows.select("id", "rank")
    pairs = joins.cosine_join(v, v, 0.82).join(ranks.select(F.col("id").alias("query"), F.col("rank").alias("rq")), "query").join(ranks, "id")
    pairs = pairs.where(F.struct("rq", "query") > F.struct("rank", "id")).select(F.col("query").alias("lo"), F.col("id").alias("hi"), "cosine")
    return dedupe.semantic_passes(some_rows, dedupe.stored(pairs), CFG).select(F.col("id").alias("item_id"), "status", "merge_reason", "matched_to")


@query(f"""{KEYED} SELECT item_id FROM (SELECT item_id, row_number() OVER (PARTITION BY dedupe_key ORDER BY (source IN {tuple(CFG.tier_a)}) DESC, score DESC, published_at DESC NULLS LAST, item_id) AS n FROM keyed) WHERE n = 1""")
def unique_keys(spark, sf_dir):
    """DED-8."""
    df = keyed(spark, sf_dir, only=()).select("id", "dedupe_key", F.when(F.col("source").isin(*CFG.tier_a), "ok").otherwise("low").alias("quality"), F.lit(0).alias("tier"), F.col("score").alias("importance"), "published_at")
    return dedupe.unique_keys(dedupe.stored(df)).select(F.col("id").alias("item_id"))


# aggregates


@query(f"""{DERIVED} SELECT category, source, count(*) AS n FROM derived WHERE reason IS NULL GROUP BY GROUPING SETS ((category), (source))""")
def mix_stats(spark, sf_dir):
    """AGG-3."""
    return aggregates.mix_stats(derived(spark, sf_dir).where(F.col("reason").isNull()))


@query(f"""{DERIVED}, l AS (SELECT 'total' AS metric, 'in' AS name FROM derived UNION ALL SELECT 'total', CASE WHEN reason IS NULL THEN 'out' ELSE 'dropped' END FROM derived UNION ALL SELECT 'source', source FROM derived UNION ALL SELECT 'category', category FROM derived
 UNION ALL SELECT 'importance', (1 + len(signals) + len(longs))::VARCHAR FROM derived UNION ALL SELECT 'drop_reason', reason FROM derived WHERE reason IS NOT NULL UNION ALL SELECT 'label', unnest(signals) FROM derived)
SELECT metric, name, count(*) AS n FROM l GROUP BY 1, 2""")
def digest_metrics(spark, sf_dir):
    """AGG-5."""
    return aggregates.digest_metrics(derived(spark, sf_dir).select(F.col("reason").alias("drop_reason"), "source", "category", (1 + F.size("signals") + F.size("longs")).alias("importance"), "signals"))


@query("""WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS date, CASE WHEN value > 20 THEN 'kept' ELSE 'dropped' END AS status FROM events)
SELECT date, count(*) FILTER (status = 'kept') AS n_items, date = (SELECT max(date) FROM r) AS latest FROM r GROUP BY date""")
def archive_index(spark, sf_dir):
    """AGG-6."""
    return aggregates.archive_index(table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(F.col("value") > 20, "kept").otherwise("dropped").alias("status")))


@query(f"""{ARTICLES}, f AS (SELECT item_id, source, first_value(item_id) OVER (PARTITION BY title ORDER BY item_id) AS matched_to FROM articles WHERE title <> '')
SELECT matched_to, array_to_string(list(source ORDER BY item_id), ',') AS sources, count(*) AS n FROM f WHERE item_id <> matched_to GROUP BY 1""")
def merged_sources(spark, sf_dir):
    """AGG-7."""
    first = F.first("item_id").over(Window.partitionBy("title").orderBy("item_id"))
    df = articles(spark, sf_dir).where("title <> ''").select("item_id", F.col("item_id").alias("rank"), "title", "source", first.alias("matched_to")).where("item_id <> matched_to")
    return aggregates.merged_sources(df).select("matched_to", F.array_join(F.transform("mentions", lambda x: x["source"]), ",").alias("sources"), "n")


@query(f"""{CLUSTERED}, {PREFIXED} SELECT merge_reason, count(*) AS n FROM (SELECT merge_reason FROM clustered WHERE merge_reason IS NOT NULL UNION ALL SELECT 'key_prefix' FROM prefixed WHERE matched_to IS NOT NULL) GROUP BY 1""")
def merge_metrics(spark, sf_dir):
    """AGG-2 over two passes."""
    rows = dedupe.stored(keyed(spark, sf_dir, only=("cluster_key",)).select("id", "rank", "title", "dedupe_key", "cluster_key"))
    a = dedupe.cluster_duplicates(rows.select("id", "rank", "title", "dedupe_key", "cluster_key"), CFG).select("merge_reason")
    b = dedupe.key_prefixes(rows.select("id", "rank", "dedupe_key")).select("merge_reason")
    return aggregates.merge_metrics(a.unionByName(b))


# selection


@query(f"""{DERIVED}, r AS (SELECT item_id, category, score, row_number() OVER (PARTITION BY category ORDER BY score DESC, item_id) AS category_rank, {case("category = '{}'", selection.quotas(CFG).items(), "NULL")} AS quota FROM derived)
SELECT item_id, phase FROM (SELECT item_id, score, CASE WHEN category_rank <= quota THEN 0 WHEN quota IS NULL THEN 1 ELSE 2 END AS phase FROM r ORDER BY phase, score DESC, item_id LIMIT {CFG.importance_limit})""")
def importance_candidates(spark, sf_dir):
    """TOP-5, WIN-2 (a top-k report)."""
    return selection.importance_candidates(derived(spark, sf_dir).select("item_id", "category", "score"), CFG).select("item_id", "phase")


@query(f"""{DERIVED} SELECT item_id, strftime(published_at, '%Y-%m-%d') || '_' || row_number() OVER (PARTITION BY strftime(published_at, '%Y-%m-%d') ORDER BY -score, item_id) AS id FROM derived WHERE published_at IS NOT NULL""")
def output_ids(spark, sf_dir):
    """WIN-4."""
    df = derived(spark, sf_dir).where("published_at IS NOT NULL").select("item_id", F.date_format("published_at", "yyyy-MM-dd").alias("date"), (-F.col("score")).alias("pick_rank"))
    return selection.output_ids(df).select("item_id", "id")


@query(f"""{DERIVED} SELECT item_id, coalesce(abs(epoch(published_at) - epoch(TIMESTAMP '2024-01-03 00:00:00')) / 3600 > 48, FALSE) AS outdated FROM derived""")
def outdated(spark, sf_dir):
    """FLT-12."""
    return derived(spark, sf_dir).select("item_id", filters.outdated(F.col("published_at"), F.lit("2024-01-03").cast("date"), F.lit(False), 48.0).alias("outdated"))


@query()
def quality_gates(spark, sf_dir):
    """FLT-11, FLT-14, FLT-16, FLT-17."""
    df = keyed(spark, sf_dir, scored=False, only=())
    return tx.staged(df, lines=tx.summary_lines(F.col("full_text"), CFG)).select(
        "item_id", filters.body_reason(F.col("full_text"), F.lit(200), F.lit("heuristic")).alias("body"), filters.unusable(F.col("title"), F.col("lines")).alias("unusable"),
        filters.integrity(F.col("title"), F.col("dedupe_key"), F.col("title"), F.col("summary")).alias("integrity"), filters.guardrail(F.col("title"), F.col("lines"), F.col("summary"), tk.lit_array(()), CFG).alias("guardrail"),
    )


def _count(words) -> str:
    return "(" + " + ".join(f"contains(lower(text), '{w}')::INT" for w in words) + ")"


_ENDINGS = {1: " - one - two - three - four of the latest economy", 2: " - one - two - three - four of the latest", 3: " and so on… and on… and on… - here - there", 4: " and on… and on… - here - there", 5: " permission is hereby granted"}


@query(f"""WITH t AS (SELECT doc_id, coalesce(text, '') || CASE doc_id % 8 {' '.join(f"WHEN {k} THEN '{x}'" for k, x in _ENDINGS.items())} ELSE '' END AS text FROM documents), d AS (SELECT *, len(string_split(text, ' - ')) - 1 AS dashes, len(string_split(text, '…')) - 1 AS dots FROM t)
SELECT doc_id AS item_id, CASE WHEN length(trim(text)) < 50 THEN 'too_short' WHEN {_count(CFG.script_marks)} >= 3 THEN 'script' WHEN {_count(CFG.style_marks)} >= 3 THEN 'style'
 WHEN {_count(w.lower() for w in CFG.boilerplate)} >= 2 OR {_count(CFG.strong_marks)} >= 1 THEN 'policy' WHEN {_count(CFG.login_marks)} >= 1 THEN 'login' WHEN (dashes >= 4 AND {_count(CFG.section_hints)} >= 2) OR (dots >= 3 AND dashes >= 2) THEN 'listing' END AS reason FROM d""")
def article_gate(spark, sf_dir):
    """FLT-20, over texts of which some end in the shape of a listing, or nearly, or in a licence."""
    end = F.lit("")
    for k, x in _ENDINGS.items():
        end = F.when(F.col("doc_id") % 8 == k, x).otherwise(end)
    text = F.concat(F.coalesce("text", F.lit("")), end)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), filters.article_gate(text, CFG).alias("reason"))


# pages


@query("""WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages), q AS (SELECT *, len(list_filter(string_split(path, '/'), lambda x: x <> '')) AS parts FROM p)
SELECT page_id, CASE WHEN host = '' THEN 'invalid' WHEN regexp_matches(path, '(?i)\\.(?:jpe?g|png|gif|webp|svg|mp4|mp3|avi|mov|pdf|zip)$') OR regexp_matches(host, '^(?:img|image|video|cdn)[.]') THEN 'media'
 WHEN host IN ('news.google.com', 'www.google.com', 'www.youtube.com', 'www.facebook.com') THEN 'portal' WHEN parts = 0 THEN 'root' WHEN parts = 1 AND length(path) < 12 THEN 'section' ELSE 'article' END AS url_class FROM q""")
def url_classes(spark, sf_dir):
    """FLT-19."""
    return table(spark, sf_dir, "pages").select("page_id", filters.url_class(F.col("url")).alias("url_class"))


@query()
def page_outlinks(spark, sf_dir):
    """TXT-2."""
    return pages.outlinks(table(spark, sf_dir, "pages"))


@query()
def page_bodies(spark, sf_dir):
    """TXT-1, TXT-3, TXT-4, TXT-5, SRC-8."""
    return pages.page_bodies(table(spark, sf_dir, "pages")).select("url", F.length("body").alias("n_body"), "meta.final_url", "meta.html_len", "meta.extractor", pages.redirect_target(F.array("meta.requested_url", "meta.final_url"), F.col("meta.final_url")).alias("target"))


@query()
def block_scores(spark, sf_dir):
    """TXT-4."""
    b = pages.blocks(table(spark, sf_dir, "pages"))
    return b.select("page_id", "pos", "tag", F.length("text").alias("n"), "link_chars", F.round(pages.block_score(F.col("text"), F.col("link_chars")), 6).alias("score"))


# sources and sinks


@query("SELECT doc_id AS item_id, quality AS importance, CASE WHEN toxic = 1 THEN 'low_quality' ELSE 'ok' END AS quality_label FROM labels")
def judgments(spark, sf_dir):
    """SRC-9: fenced and broken JSON parses to the judged values."""
    body = F.concat(F.lit('{"importance_score": '), F.col("quality"), F.lit(', "quality_label": "'), F.when(F.col("toxic") == 1, "low_quality").otherwise("ok"), F.lit('"'))
    raw = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("}\n```"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Sure: "), body, F.lit(",}"))).otherwise(F.concat(body, F.lit("}")))
    j = feeds.judgments(raw)
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), j["importance_score"].alias("importance"), j["quality_label"].alias("quality_label"))


def _folder(spark: SparkSession) -> str:
    return f"{dedupe.folder(spark)}/{uuid.uuid4().hex}"


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def dated_write(spark, sf_dir):
    """SNK-1, SNK-2, SNK-4: partitions are written, one is replaced, and all are read back."""
    path = _folder(spark)
    rows = table(spark, sf_dir, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("date"))
    sinks.write_dated(rows, path)
    sinks.write_dated(rows.where("date = '2024-01-02'"), path)
    back = sinks.read_dated(spark, path, "event_id long, value double, date string")
    return back.groupBy("date").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""{DERIVED}, r AS (SELECT item_id, published_at::DATE AS date, title FROM derived) SELECT item_id::VARCHAR AS id, strftime(date, '%Y-%m-%d') AS date, title FROM r WHERE (date < DATE '2024-01-03' AND date >= DATE '2024-01-01') OR (date = DATE '2024-01-03' AND item_id % 2 = 0)""")
def history_upsert(spark, sf_dir):
    """SNK-3, SRC-6: today's kept rows replace the date's, old dates go."""
    df = derived(spark, sf_dir).select(F.to_date("published_at").alias("date"), F.col("item_id").cast("string").alias("id"), F.col("title").alias("dedupe_key"), F.col("source").alias("cluster_key"), "title", "summary", F.when(F.col("item_id") % 2 == 0, "kept").otherwise("dropped").alias("status"))
    return sinks.upsert_history(df, df, "2024-01-03", 2).select("id", F.date_format("date", "yyyy-MM-dd").alias("date"), "title")


def _streamed(rows: DataFrame, parts, **options) -> DataFrame:
    """rows land in several steps, each one micro-batch of a stream that drops recent repeats; what survived is read back.

    Each step is judged by a run that goes on from the checkpoint. A limit of files per trigger would
    cut a step of many files into micro-batches with days in any order.
    """
    spark = rows.sparkSession
    landed, out = _folder(spark), _folder(spark)
    rows = dedupe.stored(rows)
    for part in parts:
        rows.where(part).write.mode("append").parquet(landed)
        stream = without_recent(spark.readStream.schema(rows.schema).parquet(landed), **options)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def walk_sql(days: int) -> str:
    """Steps that end in kept(k, day): of days(k, day) those without a kept one on the days before."""
    return f"kept AS (SELECT k, min(day) AS day FROM days GROUP BY 1 UNION ALL SELECT d.k, min(d.day) FROM kept JOIN days d ON d.k = kept.k AND d.day > kept.day + {days} GROUP BY 1)"


@query(recursive(f"""{KEYED}, d AS (SELECT item_id, cluster_key AS k, published_at, (published_at + INTERVAL 9 HOUR)::DATE AS day FROM keyed),
 days AS (SELECT DISTINCT k, day FROM d WHERE k <> '' AND day IS NOT NULL), {walk_sql(1)}
SELECT item_id, k AS cluster_key, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM d WHERE k = '' OR day IS NULL OR (k, day) IN (SELECT (k, day) FROM kept)"""))
def recent_stream(spark, sf_dir):
    """STR-1: articles arrive day by day; one whose cluster key survived on the calendar day before goes. Stateful, expired by timers."""
    rows = keyed(spark, sf_dir, scored=False, only=("cluster_key",)).select("item_id", "cluster_key", F.col("published_at").cast("timestamp").alias("published_at"))
    days = [f"published_at < '2024-01-01 15:00:00' OR published_at IS NULL", *(f"published_at >= '2024-01-0{d} 15:00:00' AND published_at < '2024-01-0{d + 1} 15:00:00'" for d in range(1, 4)), "published_at >= '2024-01-04 15:00:00'"]
    df = _streamed(rows, days, days=1, delay="1 day")
    return df.select("item_id", "cluster_key", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


@query(f"""WITH RECURSIVE e AS (SELECT event_id, user_id AS k, ts, (ts + INTERVAL 9 HOUR)::DATE AS day FROM events),
 past AS (SELECT DISTINCT user_id AS k, ts::DATE AS day FROM events WHERE ts < TIMESTAMP '2024-01-08 15:00:00' AND value > 90),
 days AS (SELECT DISTINCT k, day FROM e WHERE ts >= TIMESTAMP '2024-01-08 15:00:00' AND NOT EXISTS (SELECT 1 FROM past p WHERE p.k = e.k AND p.day BETWEEN e.day - {CFG.history_days} AND e.day - 1)), {walk_sql(CFG.history_days)}
SELECT event_id, k AS user_id, strftime(day, '%Y-%m-%d') AS day FROM e SEMI JOIN kept USING (k, day) WHERE ts >= TIMESTAMP '2024-01-08 15:00:00'""")
def recent_events(spark, sf_dir):
    """STR-1, SRC-5 over a month of events: what earlier days left is the initial state, then the stream judges four landed weeks."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    begin = F.lit("2024-01-08 15:00:00").cast("timestamp")
    history = events.where((F.col("ts") < begin) & (F.col("value") > 90)).select("user_id", F.to_date("ts").alias("date"))
    weeks = ["ts < '2024-01-15 15:00:00'", "ts >= '2024-01-15 15:00:00' AND ts < '2024-01-22 15:00:00'", "ts >= '2024-01-22 15:00:00' AND ts < '2024-01-27 15:00:00'", "ts >= '2024-01-27 15:00:00'"]
    df = _streamed(events.where(F.col("ts") >= begin).select("event_id", "user_id", "ts"), weeks, key="user_id", at="ts", days=CFG.history_days, delay="1 day", history=history)
    return df.select("event_id", "user_id", F.date_format(F.col("ts") + F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd").alias("day"))


# the judged side and what is published

RAW = """raw AS (SELECT d.*, CASE item_id % 7 WHEN 0 THEN 'x' WHEN 1 THEN NULL ELSE (item_id % 9 - 1)::VARCHAR END AS raw_importance, ['Low_Quality', 'good', 'badly done', '', 'fine', 'REJECT '][(item_id % 6 + 1)::INT] AS raw_quality,
 ['Promo', 'rumor', 'promo', source, 'LISTING'][1:(item_id % 6)::INT] AS raw_tags, CASE WHEN item_id % 5 = 0 THEN 'purchases' WHEN item_id % 5 = 1 THEN ' Global view' ELSE topic END AS raw_category FROM derived d)"""


def _raw(spark, sf_dir) -> DataFrame:
    k = F.col("item_id")
    said = lambda words, n: F.get(F.array(*map(F.lit, words)), (k % n).cast("int"))
    tags = F.array(F.lit("Promo"), F.lit("rumor"), F.lit("promo"), F.col("source"), F.lit("LISTING"))
    return derived(spark, sf_dir, reasons=False).withColumns({
        "raw_importance": F.when(k % 7 == 0, "x").when(k % 7 != 1, (k % 9 - 1).cast("string")),
        "raw_quality": said(("Low_Quality", "good", "badly done", "", "fine", "REJECT "), 6),
        "raw_tags": F.slice(tags, F.lit(1), (k % 6).cast("int")),
        "raw_category": F.when(k % 5 == 0, "purchases").when(k % 5 == 1, " Global view").otherwise(F.col("topic")),
    })


_SAID = "lower(trim(coalesce({}, '')))"
_LEVELS = " ".join(f"WHEN list_has_any(signals, {listed(labels)}) THEN {n}" for n, labels in CFG.fallback_levels)
_CATEGORY = " ".join(f"WHEN {_SAID.format('raw_category')} IN ({', '.join(repr(s) for s in synonyms)}) THEN '{name}'" for name, synonyms, _ in CFG.judged_categories) + " " + " ".join(f"WHEN {said('raw_category', parts)} THEN '{name}'" for name, _, parts in CFG.judged_categories)


@query(f"""{DERIVED}, {RAW} SELECT item_id, coalesce(greatest(1, least(5, try_cast(raw_importance AS BIGINT))), CASE {_LEVELS} ELSE 2 END)::INT AS importance,
 CASE WHEN {_SAID.format('raw_quality')} IN {CFG.low_words} THEN 'low_quality' WHEN {_SAID.format('raw_quality')} IN {CFG.ok_words} THEN 'ok' WHEN contains(lower(raw_quality), 'low') OR contains(lower(raw_quality), 'bad') THEN 'low_quality' ELSE 'ok' END AS quality,
 array_to_string(list_filter(['promo', 'rumor', 'listing'], lambda x: list_contains(list_transform(raw_tags, lambda y: lower(y)), x)), ',') AS tags, CASE {_CATEGORY} ELSE '' END AS category FROM raw""")
def label_fields(spark, sf_dir):
    """PRJ-18: judged importance, quality, tags and category in their allowed forms."""
    df = _raw(spark, sf_dir)
    return df.select("item_id", judged.importance(F.col("raw_importance"), F.col("signals"), CFG).alias("importance"), judged.quality_label(F.col("raw_quality"), CFG).alias("quality"), F.array_join(judged.allowed_labels(F.col("raw_tags"), CFG.allowed_tags), ",").alias("tags"), judged.category(F.col("raw_category"), CFG).alias("category"))


_WHY = " ".join(f"WHEN list_has_any(signals, {listed(labels)}) THEN '{said_}'" for labels, said_ in CFG.why_texts)


@query(f"""{DERIVED} SELECT item_id, CASE WHEN len(signals) = 0 THEN '' {_WHY} ELSE '{CFG.why_default}' END AS why, CASE reason WHEN 'freshness' THEN 'too old' ELSE 'left out' END AS told,
 CASE WHEN item_id % 3 = 0 AND {said('topic', ('click', 'view'))} THEN 'culture' ELSE category END AS category FROM derived""")
def why_texts(spark, sf_dir):
    """PRJ-21, PRJ-17: stock reasons by signals and by drop reason; a judged category that is allowed wins."""
    df = derived(spark, sf_dir)
    given = F.when((F.col("item_id") % 3 == 0) & F.col("topic").isin("click", "view"), "culture").when(F.col("item_id") % 3 == 1, "nonsense")
    told = judged.drop_text(F.when(F.col("reason") == "freshness", "outdated").otherwise(F.col("reason")), CFG)
    return df.select("item_id", judged.why_text(F.col("signals"), CFG).alias("why"), told.alias("told"), tx.item_category(given, F.col("topic"), CFG).alias("category"))


def _judgments(spark, sf_dir) -> DataFrame:
    """Judgments that the articles themselves give: their sentences as summary lines, the first one as evidence."""
    df = _raw(spark, sf_dir)
    df = tx.staged(df, sentences=F.slice(tx.sentences(tx.collapse(F.col("full_text"))), 1, 5))
    parts = F.col("sentences")
    pairs = F.transform("signals", lambda s: F.struct(s.alias("label"), F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("evidence")))
    none = F.lit(None).cast("string")
    return df.select("item_id", F.col("title").alias("raw_title"), parts.alias("summary_lines"), none.alias("why"), none.alias("rationale"), F.lower(F.regexp_replace("title", "[^A-Za-z]+", "-")).alias("raw_key"), pairs.alias("impact_signals"), "raw_importance", "raw_quality", "raw_tags", "raw_category")


@query()
def judged_records(spark, sf_dir):
    """PRJ-25, PRJ-20, PRJ-19, SIG-4, FLT-17: the record of each article with a body (rows; the rules are tested)."""
    rows = keyed(spark, sf_dir, only=()).select("item_id", "title", "summary", "full_text", "signals", "dedupe_key")
    # both sides are staged: a later projection would otherwise compute the folds again for each of its columns
    out = judged.record(dedupe.stored(rows), dedupe.stored(_judgments(spark, sf_dir)), CFG)
    return out.drop("detail").withColumns({"lines": F.array_join("lines", "\n"), "labels": F.array_join("labels", ","), "tags": F.array_join("tags", ",")})


def _published(spark, sf_dir) -> DataFrame:
    q = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"), F.when(F.col("quality") == 1, 4).alias("importance"), F.when(F.col("quality") == 0, "low_quality").alias("quality"))
    df = derived(spark, sf_dir).where("published_at IS NOT NULL").join(q, "item_id", "left")
    detail = F.transform("signals", lambda s: F.struct(s.alias("label"), F.lit("").alias("evidence")))
    return df.select(
        F.date_format("published_at", "yyyy-MM-dd").alias("date"), (-F.col("score")).alias("pick_rank"), "item_id", "title", F.array("summary").alias("lines"), F.when(F.col("item_id") % 4 == 0, F.concat(F.lit("https://resolved.example/"), F.col("item_id").cast("string"))).otherwise("").alias("resolved_url"), "link",
        F.when(F.col("item_id") % 5 != 0, F.col("published_at")).alias("published_at"), (F.col("published_at") + F.expr("INTERVAL 1 HOUR")).alias("updated_at"), "source", "category", judged.why_text(F.col("signals"), CFG).alias("why"), F.lit("").alias("rationale"),
        detail.alias("detail"), "longs", "importance", "quality", F.lit("").alias("quality_reason"), F.lower("title").alias("dedupe_key"), F.col("source").alias("cluster_key"), F.lit(None).cast("string").alias("status"), F.col("reason").alias("drop_reason"),
    )


_INFERRED = "coalesce(list_max(list_transform(signals, lambda x: CASE WHEN list_contains(longs, x) THEN 4 WHEN x IN ('policy', 'sanctions') THEN 2 " + " ".join(f"WHEN x = '{k}' THEN {n}" for k, n in CFG.base_levels) + " ELSE 2 END)), 1)"
PUBLISHED = f"""{DERIVED}, r AS (SELECT d.*, strftime(published_at, '%Y-%m-%d') AS date, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS key, l.quality AS q FROM derived d LEFT JOIN labels l ON l.doc_id = d.item_id WHERE published_at IS NOT NULL AND reason IS NULL),
 f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, key ORDER BY -score, item_id) AS n FROM r) WHERE n = 1 OR key = ''),
 published AS (SELECT *, date || '_' || row_number() OVER (PARTITION BY date ORDER BY -score, item_id) AS id, coalesce(CASE WHEN q = 1 THEN 4 END, {_INFERRED}) AS worth FROM f)"""


@query(f"""{PUBLISHED} SELECT id, item_id, CASE WHEN item_id % 4 = 0 THEN 'https://resolved.example/' || item_id ELSE link END AS source_url, strftime(published_at + CASE WHEN item_id % 5 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S') AS published_at,
 CASE WHEN len(signals) = 0 THEN least(worth, 2) ELSE worth END::INT AS importance, CASE WHEN q = 0 THEN 'low_quality' ELSE 'ok' END AS quality, CASE WHEN q = 0 THEN 'too little information' ELSE 'informative' END AS quality_reason, CASE WHEN len(signals) = 0 THEN '{CFG.why_missing}' {_WHY} ELSE '{CFG.why_default}' END AS why FROM published""")
def output_rows(spark, sf_dir):
    """PRJ-24: each day's rows as they are published."""
    df = output.output_rows(_published(spark, sf_dir), CFG)
    return df.select("id", "item_id", "source_url", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"), "importance", "quality", "quality_reason", "why")


@query(f"{PUBLISHED} SELECT date AS snapshot, count(*)::INT AS n FROM published GROUP BY date")
def archive_scan(spark, sf_dir):
    """SNK-2, SRC-7: snapshots are written, one JSON document a date, and scanned again."""
    path = _folder(spark)
    rows = output.output_rows(_published(spark, sf_dir), CFG)
    place = F.regexp_extract("id", "_([0-9]+)$", 1).cast("int")
    sinks.write_snapshots(rows.select("date", place.alias("pick_rank"), "id", "category", "title", "dedupe_key", "cluster_key", "status", "importance", "source_name"), path)
    return feeds.archived(feeds.digests(spark, path))


@query(f"{PUBLISHED} SELECT id, title FROM published WHERE date = (SELECT max(date) FROM published)")
def prior_digest(spark, sf_dir):
    """SRC-6: the last edition of an archive."""
    path = _folder(spark)
    rows = output.output_rows(_published(spark, sf_dir), CFG)
    place = F.regexp_extract("id", "_([0-9]+)$", 1).cast("int")
    sinks.write_snapshots(rows.select("date", place.alias("pick_rank"), "id", "category", "title", "dedupe_key", "cluster_key", "status", "importance", "source_name"), path)
    return feeds.last_edition(feeds.digests(spark, path)).select("id", "title")


@query("SELECT source AS feed_id, count(*) AS n, count(CASE WHEN coalesce(text, '') <> '' THEN 1 END) AS with_text, min(doc_id) AS first FROM documents GROUP BY 1")
def union_feeds(spark, sf_dir):
    """SET-1, SRC-1: entries of two landed feeds, read by one schema and joined into one table."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("feed_id"), F.col("doc_id").alias("pos"), F.coalesce("text", F.lit("")).alias("summary"))
    landed = []
    for part in (0, 1):
        landed.append(_folder(spark))
        docs.where(F.pmod("pos", F.lit(2)) == part).write.json(landed[-1])
    df = feeds.union_feeds(*(feeds.json_entries(spark, p) for p in landed))
    return df.groupBy("feed_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce("summary", F.lit("")) != "").alias("with_text"), F.min("pos").cast("long").alias("first"))


@query(f"""{DERIVED}, l AS (SELECT 'total' AS metric, 'in' AS name FROM derived UNION ALL SELECT 'total', CASE WHEN reason IS NULL THEN 'out' ELSE 'dropped' END FROM derived UNION ALL SELECT 'source', source FROM derived UNION ALL SELECT 'category', category FROM derived
 UNION ALL SELECT 'importance', (1 + len(signals) + len(longs))::VARCHAR FROM derived UNION ALL SELECT 'drop_reason', reason FROM derived WHERE reason IS NOT NULL UNION ALL SELECT 'label', unnest(signals) FROM derived)
SELECT metric, name, 2 * count(*) AS n FROM l GROUP BY 1, 2""")
def metrics_log(spark, sf_dir):
    """SNK-4: the metrics of two runs are appended to a log and summed up."""
    path = _folder(spark)
    for _ in range(2):
        sinks.append_log(QUERIES["digest_metrics"](spark, sf_dir), path)
    back = sinks.read_dated(spark, path, "metric string, name string, n long")
    return back.groupBy("metric", "name").agg(F.sum("n").alias("n"))


@query(f"""{PUBLISHED}, v AS (SELECT date, count(*) AS n FROM published GROUP BY date) SELECT date, n FROM v WHERE n <= {CFG.top_limit}""")
def guarded_publish(spark, sf_dir):
    """SNK-6: each date's edition goes out unless it is invalid; too few items still go, too many keep what was there (nothing)."""
    rows = dedupe.stored(output.output_rows(_published(spark, sf_dir), CFG).select("id", "date", "category", "title", "dedupe_key", "cluster_key", "source_name", F.lit(None).cast("string").alias("code")))
    verdict = dedupe.stored(validation.digest_valid(rows.withColumns({"item_id": F.col("id"), "pick_rank": F.regexp_extract("id", "_([0-9]+)$", 1).cast("int"), "pos": F.regexp_extract("id", "_([0-9]+)$", 1).cast("int"), "dedupe_key": F.coalesce(tx.falsy(F.col("dedupe_key")), F.col("id"))}), CFG))  # a row a date, read twice
    path = _folder(spark)
    sinks.publish_dates(rows, verdict, path)
    return sinks.read_dated(spark, path, "id string, date string").groupBy("date").agg(F.count("*").alias("n"))


@query(f"""{KEYED}, both_ AS (SELECT *, {tokens_of("concat_ws(' ', title, summary)")} AS ts FROM keyed), hist AS (SELECT * EXCLUDE (ts), {first_of_kind('ts')} AS told FROM both_ WHERE published_at::DATE BETWEEN DATE '2024-01-03' - {CFG.history_days} AND DATE '2024-01-02'),
 {cluster_steps('hist', 'own', 'told', 'rebuilt')}, {cluster_steps('rebuilt_4', 'own', 'own', 'bare')}, hk AS (SELECT item_id, published_at::DATE AS day, unnest([coalesce(nullif(cluster_key, ''), bare), rebuilt]) AS ck FROM bare_4),
 history AS (SELECT ck, max_by(item_id, (day, item_id)) AS matched_to FROM hk WHERE ck <> '' GROUP BY 1) SELECT k.item_id, h.matched_to FROM keyed k LEFT JOIN history h ON h.ck = k.cluster_key WHERE k.published_at::DATE = DATE '2024-01-03'""")
def recent_duplicates(spark, sf_dir):
    """SRC-5, JON-1, FLT-1: what the three days before had under either key is a recent duplicate (rows; the rule is tested)."""
    rows = dedupe.stored(keyed(spark, sf_dir, scored=False, only=("cluster_key",)).select("item_id", "title", "summary", "dedupe_key", "cluster_key", F.to_date("published_at").alias("date")))
    history = feeds.recent_history(rows.withColumn("id", F.col("item_id")), "2024-01-03", CFG.history_days, CFG)
    return joins.history_lookup(rows.where("date = DATE '2024-01-03'"), history).select("item_id", "matched_to")
