"""Duplicate passes one after the other, with each walk as a recursive DuckDB query over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.config import DEFAULT as CFG
from gazette.operators import aggregates, dedupe
from gazette.plans.articles import keyed
from gazette.plans.queries import _DATE, _NAMES, _NOISE, _VALID, KEYED, _in, _said_of, first_of_kind, grams_sql, jaccard_sql, query, recursive, some


def greedy(name: str, rows: str, edges: str, order: str) -> str:
    """Steps that end in name(item_id, hit): rows in order, each merged into the earliest kept one that edges(lo, hi) joins it with."""
    return f"""{name}_line AS (SELECT item_id, row_number() OVER (ORDER BY {order}) AS n FROM {rows}),
 {name}_above AS MATERIALIZED (SELECT l.n, l.item_id, coalesce(list(h.item_id ORDER BY h.n) FILTER (h.item_id IS NOT NULL), []) AS his FROM {name}_line l LEFT JOIN {edges} e ON e.lo = l.item_id LEFT JOIN {name}_line h ON h.item_id = e.hi AND h.n < l.n GROUP BY 1, 2),
 {name}_walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS kept, NULL::BIGINT AS item_id, NULL::BIGINT AS hit
  UNION ALL SELECT a.n, CASE WHEN len(list_filter(a.his, lambda x: list_contains(w.kept, x))) = 0 THEN list_append(w.kept, a.item_id) ELSE w.kept END, a.item_id, list_filter(a.his, lambda x: list_contains(w.kept, x))[1] FROM {name}_walk w JOIN {name}_above a ON a.n = w.n + 1),
 {name} AS (SELECT item_id, hit FROM {name}_walk WHERE n > 0)"""


TOLD = KEYED.replace("SELECT item_id, title, summary, score,", "SELECT item_id, title, summary, reason, score,") + f""",
 said_ AS (SELECT *, list_concat(rt, rs) AS spoken, {first_of_kind('own')} AS ow FROM keyed),
 known AS (SELECT *, list_filter(ow, lambda x: NOT {_NOISE.format('x')} AND NOT {_DATE.format('x')} AND {_VALID.format('x')} AND x NOT IN {_in(_NAMES)})[1:8] AS names, {some(f"CASE WHEN {_said_of('spoken', ws)} >= 1 THEN '{label}' END" for label, ws in CFG.event_labels)} AS ev, list_filter(spoken, lambda x: x IN {_in(CFG.actions)})[1] AS action,
  list_distinct(list_filter(spoken, lambda x: regexp_matches(x, '^[0-9]+$'))) AS numbers, {grams_sql('dedupe_key')} AS grams FROM said_)"""


def _apart(a: str, b: str) -> str:
    one = lambda f: f"(len({a}.{f}) > 0 AND len({b}.{f}) > 0 AND NOT list_has_any({a}.{f}, {b}.{f}))"
    return f"({one('numbers')} OR {one('names')})"


def title_sql(rows: str, name: str) -> str:
    return f"""{name}_words AS (SELECT item_id, len(ta) AS n, unnest(ta) AS w FROM {rows}), {name}_shared AS (SELECT a.item_id AS lo, b.item_id AS hi, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM {name}_words a JOIN {name}_words b ON a.w = b.w AND a.item_id <> b.item_id GROUP BY 1, 2),
 {name}_near AS (SELECT lo, hi FROM {name}_shared WHERE k / (na + nb - k)::DOUBLE >= {CFG.title_threshold}), {greedy(f'{name}_met', rows, f'{name}_near', 'item_id')},
 {name}_exact AS (SELECT k.item_id, first_value(k.item_id) OVER (PARTITION BY title ORDER BY k.item_id) AS first FROM {rows} k JOIN {name}_met w ON w.item_id = k.item_id AND w.hit IS NULL WHERE title <> ''),
 {name} AS (SELECT w.item_id, coalesce(w.hit, CASE WHEN e.first <> e.item_id THEN e.first END) AS hit FROM {name}_met w LEFT JOIN {name}_exact e ON e.item_id = w.item_id)"""


def cluster_sql(rows: str, name: str) -> str:
    held = "WINDOW w AS (PARTITION BY cluster_key ORDER BY -score, item_id)"
    return f"""{name}_1 AS (SELECT *, first_value(item_id) OVER w AS first, first_value(ta) OVER w AS ta2, first_value(dedupe_key) OVER w AS key2 FROM {rows} {held}),
 {name} AS (SELECT item_id, CASE WHEN len(list_filter(string_split_regex(cluster_key, '[/_-]'), lambda x: x <> '')) >= 2 AND item_id <> first AND {jaccard_sql('ta', 'ta2')} >= {max(0.3, CFG.title_threshold)} AND {jaccard_sql('grams', grams_sql('key2'))} >= {max(0.3, CFG.key_threshold)} THEN first END AS hit FROM {name}_1)"""


def entity_sql(rows: str, name: str) -> str:
    strong = f"regexp_matches(x, '(?:{'|'.join(CFG.org_suffixes)})$') OR regexp_matches(x, '^[가-힣]{{3,}}$') OR regexp_matches(x, '^[a-z0-9]{{5,}}$')"
    return f"""{name}_may AS (SELECT * FROM {rows} WHERE len(names) > 0 AND len(ev) > 0),
 {name}_met AS (SELECT a.item_id AS lo, b.item_id AS hi, list_filter(a.names, lambda x: list_contains(b.names, x)) AS both_, coalesce(a.action = b.action AND a.names[1] = b.names[1], FALSE) AS same, list_has_any(a.ev, b.ev) AS event FROM {name}_may a JOIN {name}_may b ON a.item_id <> b.item_id),
 {name}_near AS (SELECT lo, hi FROM {name}_met WHERE same OR (event AND (len(both_) >= 2 OR len(list_filter(both_, lambda x: {strong})) > 0))), {greedy(name, rows, f'{name}_near', '-score, item_id')}"""


def key_sql(rows: str, name: str) -> str:
    """Equal keys fold over the latest row of the key that wasn't merged so; then like bigrams over what is left."""
    told = "{'item_id': item_id, 'numbers': numbers, 'names': names}"
    return f"""{name}_line AS (SELECT item_id, dedupe_key, numbers, names, row_number() OVER (PARTITION BY dedupe_key ORDER BY -score, item_id) AS n FROM {rows} WHERE len(own) >= 2),
 {name}_fold AS (SELECT dedupe_key, n, item_id, NULL::BIGINT AS hit, {told} AS last FROM {name}_line WHERE n = 1 UNION ALL
  SELECT l.dedupe_key, l.n, l.item_id, CASE WHEN NOT {_apart('f.last', 'l')} THEN f.last.item_id END, CASE WHEN NOT {_apart('f.last', 'l')} THEN f.last ELSE {{'item_id': l.item_id, 'numbers': l.numbers, 'names': l.names}} END FROM {name}_fold f JOIN {name}_line l ON l.dedupe_key = f.dedupe_key AND l.n = f.n + 1),
 {name}_left AS (SELECT * FROM {rows} WHERE item_id NOT IN (SELECT item_id FROM {name}_fold WHERE hit IS NOT NULL)),
 {name}_near AS (SELECT a.item_id AS lo, b.item_id AS hi FROM {name}_left a JOIN {name}_left b ON a.item_id <> b.item_id AND len(a.grams) > 0 AND len(b.grams) > 0 WHERE {jaccard_sql('a.grams', 'b.grams')} >= {CFG.key_threshold} AND NOT {_apart('a', 'b')}),
 {greedy(f'{name}_met', f'{name}_left', f'{name}_near', '-score, item_id')},
 {name} AS (SELECT item_id, hit FROM {name}_fold WHERE hit IS NOT NULL UNION ALL SELECT item_id, hit FROM {name}_met)"""


def sequence(where: str) -> str:
    """Steps that end in passed(item_id, merge_reason, matched_to)."""
    left = lambda src, done: f"(SELECT * FROM {src} WHERE item_id NOT IN (SELECT item_id FROM {done} WHERE hit IS NOT NULL))"
    return f"""{TOLD}, r0 AS (SELECT * FROM known WHERE {where}), {title_sql('r0', 'titles')}, r1 AS {left('r0', 'titles')}, {cluster_sql('r1', 'clusters')}, r2 AS {left('r1', 'clusters')},
 {entity_sql('r2', 'events')}, r3 AS {left('r2', 'events')}, {key_sql('r3', 'keys')}, r4 AS {left('r3', 'keys')},
 passed AS (SELECT item_id, 'title_duplicate' AS merge_reason, hit AS matched_to FROM titles WHERE hit IS NOT NULL UNION ALL SELECT item_id, 'cluster_duplicate', hit FROM clusters WHERE hit IS NOT NULL UNION ALL SELECT item_id, 'entity_event', hit FROM events WHERE hit IS NOT NULL
  UNION ALL SELECT item_id, 'key_similarity', hit FROM keys WHERE hit IS NOT NULL UNION ALL SELECT item_id, NULL, NULL FROM r4)"""


def recorded(spark, sf_dir, where: str) -> DataFrame:
    return keyed(spark, sf_dir).where(where).select("id", F.col("item_id").alias("arrival"), "rank", "title", "dedupe_key", "cluster_key", "entities", "events", "action", "numbers")


def _shown(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").alias("item_id"), "merge_reason", "matched_to")


@query(recursive(f"{TOLD}, {key_sql('known', 'keys')} SELECT item_id, CASE WHEN hit IS NULL THEN 'kept' ELSE 'merged' END AS status, CASE WHEN hit IS NOT NULL THEN 'key_similarity' END AS merge_reason, hit AS matched_to FROM keys"))
def key_similarity(spark, sf_dir):
    """DED-4: equal keys, then like bigrams, both vetoed by numbers or entities that contradict."""
    rows = dedupe.stored(keyed(spark, sf_dir, only=("numbers", "entities")).select("id", "rank", "dedupe_key", "numbers", "entities"))
    return dedupe.key_similarity(rows, CFG).select(F.col("id").alias("item_id"), "status", "merge_reason", "matched_to")


@query(recursive(f"{sequence('TRUE')} SELECT * FROM passed"))
def passes(spark, sf_dir):
    """DED-1 to DED-4 in sequence over all articles, each pass over what the one before kept."""
    return _shown(dedupe.passes(recorded(spark, sf_dir, "true"), CFG))


@query(recursive(f"{sequence('reason IS NULL')} SELECT merge_reason, count(*) AS n FROM passed WHERE merge_reason IS NOT NULL GROUP BY 1"))
def pass_metrics(spark, sf_dir):
    """AGG-2, FLT-1: what each pass merges of the rows that pass the filters, in one run."""
    return aggregates.merge_metrics(dedupe.passes(recorded(spark, sf_dir, "reason IS NULL"), CFG).where("merge_reason IS NOT NULL").select("merge_reason"))
