"""Queries over the mixed picks of editions, with the walk as a recursive DuckDB query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.config import DEFAULT as CFG
from gazette.operators import dedupe, filters, selection
from gazette.plans.articles import derived
from gazette.plans.queries import DERIVED, listed, query, recursive, said

EDITIONS = f"""{DERIVED}, ed AS (SELECT strftime(published_at, '%Y-%m-%d') AS edition, item_id, category, source, score, list_has_any(signals, {listed(CFG.capped_signals)}) AND NOT 1 + len(signals) >= 4 AND NOT list_has_any(longs, {listed(CFG.capped_signals)}) AS capped,
 CASE WHEN age IS NULL THEN TRUE WHEN age <= {CFG.top_fresh_hours} THEN TRUE ELSE len(longs) > 0 AND age <= {CFG.stale_hours} END AS top_fresh, length(trim(full_text)) >= 400 AS eligible, {said("coalesce(source, '')", CFG.top_sources)} AS allowed FROM derived WHERE reason IS NULL)"""


def _held(chosen: str, field: str, value: str) -> str:
    return f"len(list_filter({chosen}, lambda h: h.{field} IS NOT DISTINCT FROM {value}))"


def _below(chosen: str, r: str) -> str:
    return f"CASE {r}.category " + " ".join(f"WHEN '{c}' THEN {_held(chosen, 'category', f'{r}.category')} < {n}" for c, n in CFG.category_caps) + " ELSE TRUE END"


def _free(chosen: str, r: str) -> str:
    return f"{_held(chosen, 'source', f'{r}.source')} < {CFG.source_cap}"


def pick_sql(src: str, limits: str, name: str) -> str:
    """src(edition, item_id, category, source, score, capped) and limits(edition, lim) to name(edition, chosen, replaced). Every minimum is 1."""
    k, order = len(CFG.category_minimums), "score DESC, item_id"
    names = [c for c, _ in CFG.category_minimums]
    may = " ".join(f"WHEN {i} THEN coalesce(n.least, 0) > 0 AND {_held('w.chosen', 'category', 's.category')} < n.least AND {_free('w.chosen', 's')}" for i in range(k))
    row = "{'item_id': s.item_id, 'category': s.category, 'source': s.source, 'score': s.score, 'capped': s.capped}"
    return f"""{name}_pool AS (SELECT edition, list({{'item_id': item_id, 'category': category, 'source': source, 'score': score, 'capped': capped}} ORDER BY {order}) AS pool FROM {src} GROUP BY 1),
 {name}_min AS (SELECT edition, category, max(score) AS strength FROM {src} WHERE category IN ({', '.join(f"'{c}'" for c in names)}) GROUP BY 1, 2),
 {name}_rank AS (SELECT m.*, row_number() OVER (PARTITION BY m.edition ORDER BY strength, category) AS weak, count(*) OVER (PARTITION BY m.edition) - lim AS over FROM {name}_min m JOIN {limits} USING (edition)),
 {name}_need AS (SELECT edition, category, CASE WHEN weak <= over THEN 0 ELSE 1 END AS least FROM {name}_rank),
 {name}_phase AS (SELECT *, unnest(range(0, {k + 3})) AS phase FROM {src}),
 {name}_step AS (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY phase, {order}) AS n FROM {name}_phase WHERE phase >= {k} OR category = {listed(names)}[phase + 1]),
 {name}_walk AS (SELECT edition, 0::BIGINT AS n, list_filter(pool, lambda x: FALSE) AS chosen FROM {name}_pool UNION ALL
  SELECT w.edition, s.n, CASE WHEN len(w.chosen) < l.lim AND {_held('w.chosen', 'item_id', 's.item_id')} = 0 AND CASE s.phase {may} WHEN {k} THEN {_below('w.chosen', 's')} AND {_free('w.chosen', 's')} WHEN {k + 1} THEN {_below('w.chosen', 's')} ELSE TRUE END THEN list_append(w.chosen, {row}) ELSE w.chosen END
  FROM {name}_walk w JOIN {name}_step s ON s.edition = w.edition AND s.n = w.n + 1 JOIN {limits} l ON l.edition = w.edition LEFT JOIN {name}_need n ON n.edition = s.edition AND n.category = s.category),
 {name}_first AS (SELECT edition, arg_max(chosen, n) AS chosen FROM {name}_walk GROUP BY 1),
 {name}_marked AS (SELECT edition, unnest(range(1, len(chosen) + 1)) AS i, chosen FROM {name}_first),
 {name}_victim AS (SELECT edition, chosen[i] AS v, row_number() OVER (PARTITION BY edition ORDER BY chosen[i].score, i) AS n, count(*) OVER (PARTITION BY edition) AS marked FROM {name}_marked WHERE chosen[i].capped),
 {name}_swap AS (SELECT f.edition, 0::BIGINT AS n, f.chosen, greatest(coalesce((SELECT any_value(marked) FROM {name}_victim v WHERE v.edition = f.edition), 0) - greatest(1, floor(lim * {CFG.signal_share})::INT), 0) AS over, 0 AS replaced FROM {name}_first f JOIN {limits} USING (edition) UNION ALL
  SELECT edition, n, CASE WHEN best IS NULL THEN chosen ELSE list_append(others, best) END, over - (best IS NOT NULL)::INT, replaced + (best IS NOT NULL)::INT FROM
   (SELECT *, CASE WHEN over > 0 THEN list_filter(pool, lambda r: NOT r.capped AND r.score >= v.score - {CFG.signal_slack} AND r.item_id <> v.item_id AND {_held('others', 'item_id', 'r.item_id')} = 0 AND {_below('others', 'r')} AND {_free('others', 'r')})[1] END AS best FROM
    (SELECT w.edition, v.n, w.chosen, w.over, w.replaced, v.v, p.pool, list_filter(w.chosen, lambda x: x.item_id <> v.v.item_id) AS others FROM {name}_swap w JOIN {name}_victim v ON v.edition = w.edition AND v.n = w.n + 1 JOIN {name}_pool p ON p.edition = w.edition))),
 {name} AS (SELECT edition, arg_max(chosen, n) AS chosen, arg_max(replaced, n) AS replaced FROM {name}_swap GROUP BY 1),
 {name}_rows AS (SELECT edition, chosen[i].item_id AS item_id, i::INT AS pick_rank FROM (SELECT *, unnest(range(1, len(chosen) + 1)) AS i FROM {name}))"""


WHOLE = f"lim AS (SELECT DISTINCT edition, {CFG.top_limit} AS lim FROM ed)"


def filled_sql(picked: str, rows: str, name: str) -> str:
    """The missing places of each edition from rows that aren't picked, the best first."""
    return f"""{name}_rest AS (SELECT r.*, row_number() OVER (PARTITION BY edition ORDER BY score DESC, item_id) AS n FROM {rows} r WHERE NOT EXISTS (SELECT 1 FROM {picked} p WHERE p.edition = r.edition AND p.item_id = r.item_id)), {name}_have AS (SELECT edition, count(*) AS have FROM {picked} GROUP BY 1),
 {name} AS (SELECT * FROM {picked} UNION ALL SELECT r.edition, r.item_id, (r.n + coalesce(h.have, 0))::INT FROM {name}_rest r LEFT JOIN {name}_have h USING (edition) WHERE r.n + coalesce(h.have, 0) <= {CFG.top_limit})"""


def editions(spark, sf_dir) -> DataFrame:
    """Each day's admissible articles, as they stand before a pick. Staged: the picks read them more than once."""
    df = derived(spark, sf_dir).where("reason IS NULL")
    return dedupe.stored(df.select(F.date_format("published_at", "yyyy-MM-dd").alias("edition"), "item_id", "category", "source", "score", "signals", "longs", (1 + F.size("signals")).alias("importance"), filters.top_fresh(F.col("age"), F.col("longs"), CFG).alias("top_fresh"), filters.eligible(F.lit(None).cast("string"), filters.body_reason(F.col("full_text"), F.lit(200), F.lit("heuristic"), 400)).alias("eligible"), filters.source_allowed(F.col("source"), CFG).alias("allowed")))


@query(recursive(f"{EDITIONS}, {WHOLE}, {pick_sql('ed', 'lim', 'mp')} SELECT * FROM mp_rows"))
def mix_pick(spark, sf_dir):
    """TOP-1, TOP-2: each day's mixed pick."""
    return selection.mix_pick(editions(spark, sf_dir), CFG)


SMALL = 6


@query(recursive(f"""{EDITIONS}, lim AS (SELECT DISTINCT edition, {SMALL} AS lim FROM ed), {pick_sql('ed', 'lim', 'mp')}
SELECT edition, len(chosen)::INT AS picked, greatest(1, floor({SMALL} * {CFG.signal_share})::INT)::INT AS cap_limit, replaced::INT AS replaced, len(list_distinct(list_transform(chosen, lambda x: x.source)))::INT AS sources, len(list_distinct(list_transform(chosen, lambda x: x.category)))::INT AS categories FROM mp"""))
def pick_stats(spark, sf_dir):
    """AGG-3, TOP-2: what each day's pick of six came to, and how often the signal cap replaced a row."""
    return selection.pick_stats(editions(spark, sf_dir), CFG, SMALL)


@query(recursive(f"""{EDITIONS}, {WHOLE}, {pick_sql('ed', 'lim', 'mp')}, good AS (SELECT * FROM ed WHERE eligible), stay AS (SELECT m.* FROM mp_rows m SEMI JOIN good USING (edition, item_id)), stay_n AS (SELECT edition, count(*) AS have FROM stay GROUP BY 1),
 rest AS (SELECT g.* FROM good g LEFT JOIN stay_n n USING (edition) WHERE coalesce(have, 0) < {CFG.top_limit} AND NOT EXISTS (SELECT 1 FROM stay s WHERE s.edition = g.edition AND s.item_id = g.item_id)), miss AS (SELECT DISTINCT edition, {CFG.top_limit} - coalesce(have, 0) AS lim FROM rest LEFT JOIN stay_n USING (edition)), {pick_sql('rest', 'miss', 'rp')},
 refilled AS (SELECT * FROM stay UNION ALL SELECT edition, item_id, pick_rank + {CFG.top_limit} FROM rp_rows), fresh AS (SELECT * FROM ed WHERE top_fresh), {filled_sql('refilled', 'fresh', 'filled')} SELECT * FROM filled"""))
def refilled_pick(spark, sf_dir):
    """TOP-4, JON-7, FLT-9: what stays after the body checks, a pick of the missing number from the rest, then the best fresh rows."""
    rows = editions(spark, sf_dir)
    return selection.filled(selection.refill(selection.mix_pick(rows, CFG), rows, CFG), rows.where("top_fresh"), CFG)


@query(recursive(f"""{EDITIONS}, {WHOLE}, fresh AS (SELECT * FROM ed WHERE top_fresh AND eligible), own AS (SELECT * FROM fresh WHERE allowed), {pick_sql('own', 'lim', 'ap')}, {filled_sql('ap_rows', 'fresh', 'filled')} SELECT * FROM filled"""))
def allowlist_pick(spark, sf_dir):
    """TOP-3, FLT-7: allowed outlets first, then the best fresh rows."""
    return selection.allowlist_pick(editions(spark, sf_dir), CFG, strict=False)
