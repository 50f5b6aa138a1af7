"""Queries over judged evidence and its validation, with their rules as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.config import DEFAULT as CFG
from gazette.functions import signals as sg
from gazette.functions import text as tx
from gazette.functions import tokens as tk
from gazette.operators import dedupe, validation
from gazette.sources import sinks
from gazette.plans.articles import keyed, table
from gazette.plans.queries import KEYED, _folder, _in, cluster_steps, first_of_kind, listed, normal_list, query, said, some, tokens_of

LABELS = ("policy", "security", "earnings", "infra", "capex", "market-demand", "sanctions")

# SQL building blocks

WORDS_OF = dict(CFG.signals)


def flat(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


def parts(c: str) -> str:
    return f"list_filter(string_split(regexp_replace({c}, '([.!?。])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '')"


def holds(label: str, e: str) -> str:
    """Whether evidence e supports one label."""
    found = said(e, WORDS_OF[label])
    if label == "policy":
        return f"({found} AND NOT ({said(e, CFG.trade_words)} AND NOT {said(e, CFG.policy_action)} AND NOT {said(e, CFG.government)}))"
    if label == "sanctions":
        return said(e, CFG.sanctions_words)
    if label == "earnings":
        return f"({found} AND regexp_matches({e}, '[0-9]'))"
    if label == "capex":
        return f"({found} AND ({said(e, CFG.policy_action)} OR regexp_matches({e}, '[0-9]')))"
    return found


def by_label(label: str, f, default: str) -> str:
    return f"CASE {label} " + " ".join(f"WHEN '{name}' THEN {f(name)}" for name in WORDS_OF) + f" ELSE {default} END"


def fits(label: str, e: str) -> str:
    return f"({by_label(label, lambda name: holds(name, e), 'FALSE')})"


def short(e: str) -> str:
    return f"(length({e}) < 20 OR len(list_filter(string_split_regex(trim({e}), '\\s+'), lambda x: x <> '')) < 6)"


def sort_key(label: str, e: str) -> str:
    hits = by_label(label, lambda name: "(" + " + ".join(f"contains(lower({e}), '{w.lower()}')::INT" for w in WORDS_OF[name]) + ")", "0")
    return f"{{'l': -length({e}), 'n': -regexp_matches({e}, '[0-9]')::INT, 'h': -({hits})}}"


def evidence_key(e: str) -> str:
    return f"trim(regexp_replace(lower({e}), '[^a-z0-9가-힣]+', ' ', 'g'))"


def remap(e: str) -> str:
    return "CASE " + " ".join(f"WHEN {holds(label, e)} THEN '{label}'" for label in CFG.export_order) + " END"


def rank(label: str) -> str:
    return f"CASE {label} " + " ".join(f"WHEN '{name}' THEN {k}" for k, name in enumerate(CFG.export_order)) + " ELSE 99 END"


def known(label: str) -> str:
    return f"{label} IN {_in(WORDS_OF)}"


def best_of_labels(src: str, name: str, unique_by: str) -> str:
    """src(item_id, pos, label, evidence) to name_3(..., s, k, first, met): the best of each label, then one of each evidence in the order given."""
    return f"""{name}_1 AS (SELECT *, {sort_key('label', 'evidence')} AS s, {evidence_key('evidence')} AS k FROM {src}),
 {name}_2 AS (SELECT *, min(pos) OVER (PARTITION BY item_id, label) AS first FROM {name}_1 QUALIFY row_number() OVER (PARTITION BY item_id, label ORDER BY s, pos) = 1),
 {name}_3 AS (SELECT *, min(first) OVER (PARTITION BY item_id, k) AS met FROM {name}_2 WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY item_id, k ORDER BY {unique_by}) = 1)"""


def sanitized(src: str, name: str) -> str:
    """src(item_id, pos, label, evidence, body) to name(item_id, pairs)."""
    good = f"{known('label')} AND body <> '' AND NOT {short('evidence')} AND contains(lower(body), lower(evidence)) AND {fits('label', 'evidence')}"
    return f"""{name}_0 AS (SELECT * FROM {src} WHERE {good}), {best_of_labels(f'{name}_0', name, 's, first')},
 {name} AS (SELECT item_id, list({{'label': label, 'evidence': evidence}} ORDER BY s, first) AS pairs FROM {name}_3 GROUP BY 1)"""


def mined(src: str) -> str:
    """src(item_id, body) to told(item_id, label, best, evidence) and mined(item_id, pairs)."""
    both = lambda a, b: f"concat({a}, chr(32), {b})"
    joined = lambda a, b: f"CASE WHEN NOT {short(both(a, b))} AND {fits('label', both(a, b))} THEN {both(a, b)} END"
    return f"""parts AS (SELECT item_id, body, {parts('body')} AS ps FROM {src}), labelled AS (SELECT *, unnest({listed(CFG.export_order)}) AS label FROM parts),
 places AS (SELECT item_id, label, ps, unnest(range(1, len(ps) + 1)) AS i FROM labelled), around AS (SELECT item_id, label, i, ps[i] AS p, ps[i + 1] AS after, CASE WHEN i > 1 THEN ps[i - 1] END AS before FROM places),
 good AS (SELECT * FROM around WHERE {fits('label', 'p')}),
 best AS (SELECT item_id, label, p FROM good WHERE NOT {short('p')} QUALIFY row_number() OVER (PARTITION BY item_id, label ORDER BY {sort_key('label', 'p')}, i) = 1),
 near_1 AS (SELECT item_id, label, i, CASE WHEN NOT {short('p')} THEN p ELSE coalesce(CASE WHEN after IS NOT NULL THEN {joined('p', 'after')} END, CASE WHEN before IS NOT NULL THEN {joined('before', 'p')} END) END AS p FROM good),
 near AS (SELECT item_id, label, p FROM near_1 WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY item_id, label ORDER BY i) = 1),
 told AS (SELECT l.item_id, l.label, l.body, {rank('l.label')} AS rank, b.p AS best, coalesce(b.p, n.p) AS evidence, {by_label('l.label', lambda name: said('l.body', WORDS_OF[name]), 'FALSE')} AS mentioned FROM labelled l LEFT JOIN best b ON b.item_id = l.item_id AND b.label = l.label LEFT JOIN near n ON n.item_id = l.item_id AND n.label = l.label),
 mined_all AS (SELECT *, bool_or(mentioned) OVER (PARTITION BY item_id) AS any_, row_number() OVER (PARTITION BY item_id ORDER BY rank) AS n FROM told WHERE evidence IS NOT NULL),
 mined_in AS (SELECT item_id, rank AS pos, label, evidence, body FROM mined_all WHERE mentioned OR (NOT any_ AND n = 1)), {sanitized('mined_in', 'mined')}"""


TOLD = KEYED.replace("SELECT item_id, title, summary, score,", "SELECT item_id, title, summary, full_text, signals, longs, age, score,") + f""",
 body_ AS (SELECT *, {flat('full_text')} AS body FROM keyed), ss_ AS (SELECT *, {parts('body')} AS ss FROM body_),
 base AS (SELECT *, coalesce(ss[1], '') AS e1, coalesce(ss[2], '') AS e2, {listed(LABELS)}[(item_id % 7 + 1)::INT] AS lab FROM ss_)"""


def struct_sql(label: str, evidence: str) -> str:
    return f"{{'label': {label}, 'evidence': {evidence}}}"


def exploded(src: str, column: str, name: str) -> str:
    """One row for each pair of a list column, in order."""
    return f"{name}_at AS (SELECT *, unnest(range(1, len({column}) + 1)) AS pos FROM {src}), {name} AS (SELECT item_id, body, pos, {column}[pos].label AS label, {column}[pos].evidence AS evidence FROM {name}_at)"


def told(spark, sf_dir) -> DataFrame:
    """Keyed articles with their collapsed text, its first sentences and a label in turn."""
    df = keyed(spark, sf_dir).withColumn("body", tx.collapse(F.col("full_text")))
    df = df.withColumns({"ss": tx.sentences(F.col("body")), "lab": F.get(tk.lit_array(LABELS), (F.col("item_id") % 7).cast("int"))})
    return df.withColumns({"e1": F.coalesce(F.get("ss", F.lit(0)), F.lit("")), "e2": F.coalesce(F.get("ss", F.lit(1)), F.lit(""))}).drop("ss")


def _shown(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(": ", x["label"], x["evidence"])), "\n")


def _shown_sql(c: str) -> str:
    return f"array_to_string(list_transform({c}, lambda x: x.label || ': ' || x.evidence), chr(10))"


# judgments in three forms


def json_forms() -> Column:
    """Judgments as JSON in the three forms, with entries that don't belong, and some that are no JSON."""
    text = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    join = lambda *xs: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in xs))
    obj = lambda label, e: join('{"label": "', label, '", "evidence": ', e, "}")
    e1, e2, lab, k = text(F.col("e1")), text(F.col("e2")), F.col("lab"), F.col("item_id") % 6
    detail = join('"detail": [', obj(join(" ", F.upper(lab)), e1), ', "no object", ', obj("security", e2), ', {"label": "policy"}]')
    objects = join('"signals": [', obj(lab, e1), ", 5, ", obj("earnings", e2), "]")
    labels = join('"signals": ["', lab, '", "policy"], "evidence": {"other": 7, "policy": ', e2, F.when(lab != "policy", join(', "', lab, '": ', e1)).otherwise(""), "}")
    own = join('"signals": [], "evidence": {"policy": ', e1, ', "earnings": ', e2, "}")
    whole = lambda *forms: join("{", F.concat_ws(", ", *(F.lit(f) if isinstance(f, str) else f for f in forms)), "}")
    return F.when(k == 0, whole(detail, objects)).when(k == 1, whole(objects)).when(k == 2, whole(labels)).when(k == 3, whole('"detail": []', own)).when(k == 4, whole('"detail": ["x"]', labels)).otherwise("not json")


#: What each form says.
_GIVEN = f"""CASE item_id % 6 WHEN 0 THEN [{struct_sql('lab', 'e1')}, {struct_sql("'security'", 'e2')}] WHEN 1 THEN [{struct_sql('lab', 'e1')}, {struct_sql("'earnings'", 'e2')}]
 WHEN 3 THEN list_transform(signals, lambda x: {{'label': x, 'evidence': CASE x WHEN 'policy' THEN e1 WHEN 'earnings' THEN e2 ELSE '' END}}) WHEN 5 THEN []
 ELSE [{struct_sql('lab', "CASE lab WHEN 'policy' THEN e2 ELSE e1 END")}, {struct_sql("'policy'", 'e2')}] END"""


@query(f"""{TOLD}, given AS (SELECT item_id, body, list_filter({_GIVEN}, lambda x: x.label <> '' AND x.evidence <> '') AS given FROM base), {exploded('given', 'given', 'pairs')}, {sanitized('pairs', 'clean')}, {mined('base')},
 found AS (SELECT g.item_id, coalesce(c.pairs, m.pairs, []) AS found, len(g.given)::INT AS n_given, c.pairs IS NULL AND m.pairs IS NOT NULL AS mined FROM given g LEFT JOIN clean c USING (item_id) LEFT JOIN mined m USING (item_id))
SELECT item_id, {_shown_sql('found')} AS detail, n_given, mined FROM found""")
def signal_detail(spark, sf_dir):
    """SIG-7, SIG-6, SIG-8, SIG-5, WIN-3: pairs from judgments in three JSON forms, sanitised, or mined where none holds."""
    df = dedupe.stored(told(spark, sf_dir).select("item_id", "body", "signals", "lab", "e1", "e2"))
    df = tx.staged(tx.staged(df, given=sg.given_pairs(json_forms(), F.col("signals"))), good=sg.sanitized(F.col("given"), F.col("body"), CFG))
    df = tx.staged(df, found=F.when(F.size("good") > 0, F.col("good")).otherwise(sg.mined(F.col("body"), CFG)))
    return df.select("item_id", _shown("found").alias("detail"), F.size("given").alias("n_given"), ((F.size("good") == 0) & (F.size("found") > 0)).alias("mined"))


@query()
def signal_labels(spark, sf_dir):
    """SIG-3, SIG-4, SIG-9, SCR-4: judged pairs and labels against the rule's, and the importance they give (rows; the rules are tested)."""
    df = told(spark, sf_dir)
    given = F.transform("signals", lambda s: F.struct(s.alias("label"), F.col("e1").alias("evidence")))
    rule = sg.rule_signals(F.col("body"), CFG)
    return df.select("item_id", sg.judged_pairs(given, rule, F.col("body"), CFG).alias("judged"), sg.merged_labels(F.col("signals"), rule, F.col("body"), CFG).alias("labels"), sg.inferred_importance(F.col("signals"), F.col("longs"), CFG).alias("importance"))


# rows with planted errors of every kind

NOWHERE = "this sentence stands in no text of the table at all"
#: Sentences that end two of three texts: what one label or several hold for.
SAYS = ("The secret password of the office was found by 12 clowns again.", "The released license of the public office keeps all rights reserved since 2024.")


def planted(spark, sf_dir) -> DataFrame:
    k, e1, e2, lab = F.col("item_id"), F.col("e1"), F.col("e2"), F.col("lab")
    pair = lambda label, e: F.struct((F.lit(label) if isinstance(label, str) else label).alias("label"), (F.lit(e) if isinstance(e, str) else e).alias("evidence"))
    kinds = [sg.pairs(), F.array(pair("budget", e1)), F.array(pair(lab, NOWHERE)), F.array(pair(lab, e1), pair(lab, e2)), F.array(pair("policy", e1), pair("earnings", e1)), F.array(pair(lab, "too short")), F.array(pair(lab, e1)), F.array(pair(lab, "")), F.array(pair("earnings", e2), pair("security", e1), pair("budget", e2)), F.array(pair("earnings", e1), pair("market-demand", e2))]
    detail = kinds[0]
    for n, kind in enumerate(kinds[1:], 1):
        detail = F.when(k % 10 == n, kind).otherwise(detail)
    says = F.when(k % 3 == 0, SAYS[0]).when(k % 3 == 1, SAYS[1])
    df = told(spark, sf_dir).withColumns({"body": F.trim(F.concat_ws(" ", "body", says)), "e2": F.coalesce(says, "e2")})
    return df.withColumns({
        "detail": detail,
        "dedupe_key": F.when(k % 11 == 5, "zzz-yyy").otherwise(F.col("dedupe_key")),
        "cluster_key": F.when(k % 11 == 5, "q/r").when(k % 11 == 6, "zz/yy").otherwise(F.col("cluster_key")),
        "importance": (F.floor(k / 10) % 5 + 1).cast("int"),
        "quality": F.when(k % 6 == 0, "low_quality").otherwise("ok"),
        "quality_reason": F.when(k % 4 == 0, "planted").otherwise(""),
        "why": F.when(k % 15 == 0, CFG.why_missing).otherwise("why"),
        "rationale": F.when(k % 15 == 0, CFG.rationale_low).otherwise("because"),
        "malformed": k % 13 == 0,
        "outdated": F.coalesce(F.col("age") > CFG.stale_hours, F.lit(False)),
        "stale": k % 17 == 3,
        "retry_detail": F.when(k % 3 == 0, F.array(pair(F.when(k % 2 == 0, "security").otherwise("policy"), e2))).otherwise(sg.pairs()),
        "retry_importance": (k % 7).cast("int"),
        "full_text": F.col("body"),
    })


_KINDS = [[], [("'budget'", "e1")], [("lab", f"'{NOWHERE}'")], [("lab", "e1"), ("lab", "e2")], [("'policy'", "e1"), ("'earnings'", "e1")], [("lab", "'too short'")], [("lab", "e1")], [("lab", "''")], [("'earnings'", "e2"), ("'security'", "e1"), ("'budget'", "e2")], [("'earnings'", "e1"), ("'market-demand'", "e2")]]
_PAIRS = "STRUCT(label VARCHAR, evidence VARCHAR)[]"
PLANTED = f"""{TOLD}, says AS (SELECT *, CASE item_id % 3 WHEN 0 THEN '{SAYS[0]}' WHEN 1 THEN '{SAYS[1]}' END AS extra FROM base), ending AS (SELECT * EXCLUDE (body, e2, extra), trim(concat_ws(' ', body, extra)) AS body, coalesce(extra, e2) AS e2 FROM says), planted AS (SELECT item_id, title, summary, body, own, dedupe_key AS rule_key,
  (CASE item_id % 10 {' '.join(f"WHEN {n} THEN [{', '.join(struct_sql(*p) for p in kind)}]" for n, kind in enumerate(_KINDS) if kind)} ELSE [] END)::{_PAIRS} AS detail,
  CASE WHEN item_id % 11 = 5 THEN 'zzz-yyy' ELSE dedupe_key END AS dedupe_key, CASE item_id % 11 WHEN 5 THEN 'q/r' WHEN 6 THEN 'zz/yy' ELSE cluster_key END AS cluster_key, (item_id // 10 % 5 + 1)::INT AS importance, CASE WHEN item_id % 6 = 0 THEN 'low_quality' ELSE 'ok' END AS quality,
  CASE WHEN item_id % 4 = 0 THEN 'planted' ELSE '' END AS quality_reason, item_id % 15 = 0 AS silent, item_id % 13 = 0 AS malformed, coalesce(age > {CFG.stale_hours}, FALSE) AS outdated, item_id % 17 = 3 AS stale,
  (CASE WHEN item_id % 3 = 0 THEN [{struct_sql("CASE WHEN item_id % 2 = 0 THEN 'security' ELSE 'policy' END", 'e2')}] ELSE [] END)::{_PAIRS} AS retry_detail, (item_id % 7)::INT AS retry_importance FROM ending)"""


def _flag(cond: str, code: str) -> str:
    return f"CASE WHEN {cond} THEN '{code}' END"


def _valid(t: str) -> str:
    return f"length({t}) >= CASE WHEN regexp_matches({t}, '[가-힣]') THEN 2 ELSE 3 END"


def _shared(key: str, sign: str) -> str:
    spaced = f"replace({key}, '{sign}', ' ')"
    return f"len(list_intersect(words, list_filter({tokens_of(spaced)}, lambda x: {_valid('x')})))"


def errors_sql() -> str:
    """A row's ordered distinct codes; words is the list of its title's and summary's tokens, raw and normal."""
    label, e = "detail[i].label", "detail[i].evidence"
    each = f"list_transform(range(1, len(detail) + 1), lambda i: CASE WHEN NOT {known(label)} THEN 'UNKNOWN_LABEL' WHEN {e} = '' THEN 'EVIDENCE_REQUIRED' WHEN {short(e)} THEN 'SHORT_EVIDENCE' WHEN src <> '' AND NOT contains(lower(src), lower({e})) THEN 'EVIDENCE_REQUIRED' WHEN NOT {fits(label, e)} THEN 'INVALID_' || upper({label}) END)"
    keys = f"list_filter(list_transform(detail, lambda x: {evidence_key('x.evidence')}), lambda x: x <> '')"
    bare = "importance >= 3 AND len(detail) = 0"
    excused = "((silent AND importance = 1) OR (quality_reason <> '' AND importance <= 2))"
    first = [_flag("malformed", "BAD_FORMAT"), _flag("len(list_distinct(list_transform(detail, lambda x: x.label))) < len(detail)", "DUPLICATE_LABEL"), _flag(f"len(list_distinct({keys})) < len({keys})", "DUPLICATE_EVIDENCE"), _flag(f"{_shared('dedupe_key', '-')} < 2", "KEY_MISALIGNED"), _flag(f"{_shared('cluster_key', '/')} < 1", "CLUSTER_MISALIGNED")]
    last = [_flag(f"quality = 'low_quality' AND NOT {excused}", "LOW_QUALITY_MISMATCH"), _flag(bare, "SIGNALS_REQUIRED"), _flag(f"{bare} AND {said('head', CFG.alignment_triggers)}", "SIGNALS_MISSING"), _flag("outdated", "OUTDATED"), _flag("stale", "STALE_INCIDENT")]
    return f"list_filter(list_concat([{', '.join(first)}], {each}, [{', '.join(last)}]), lambda x: x IS NOT NULL)"


def checked_sql(src: str, name: str) -> str:
    """src to name with the column of that name: the row's codes."""
    return f"{name}_all AS (SELECT *, {errors_sql()} AS codes FROM {src}), {name}_step AS (SELECT * EXCLUDE (codes), {first_of_kind('codes')} AS {name} FROM {name}_all)"


_FIXABLE = listed(validation.fixable(CFG))
_FIXES = some(["CASE WHEN other AND l1 IS NOT NULL THEN 'relabelled' END", "CASE WHEN bad AND e1 IS NOT NULL AND l1 IS NOT NULL THEN 'replaced_evidence' END", "CASE WHEN again AND label IS NOT NULL THEN 'relabelled' END"])
VALIDATED = f"""{PLANTED}, v0 AS (SELECT *, {flat("concat_ws(' ', title, summary)")} AS head, CASE WHEN body <> '' THEN body ELSE {flat('summary')} END AS src FROM planted),
 v1 AS (SELECT *, list_distinct(list_concat(list_filter({tokens_of('head')}, lambda x: {_valid('x')}), {normal_list(tokens_of('head'))})) AS words, {tokens_of('head')} AS spoken FROM v0), v1b AS (SELECT *, {first_of_kind('spoken')} AS hinted FROM v1),
 {cluster_steps('v1b', 'own', 'hinted', 'rule_cluster')}, {checked_sql('rule_cluster_4', 'errors_0')},
 v3 AS (SELECT *, list_has_any(errors_0, {_FIXABLE}) AS fix FROM errors_0_step), v4 AS (SELECT item_id, src AS body FROM v3), {mined('v4')},
 r_at AS (SELECT item_id, src AS body, detail, unnest(range(1, len(detail) + 1)) AS pos FROM v3 WHERE fix),
 r0 AS (SELECT item_id, body, pos, detail[pos].label AS l0, detail[pos].evidence AS e0 FROM r_at),
 r1 AS (SELECT *, NOT {known('l0')} AS other, CASE WHEN {known('l0')} THEN l0 ELSE {remap('e0')} END AS l1 FROM r0),
 r2 AS (SELECT r1.*, e0 = '' OR {short('e0')} OR NOT contains(lower(r1.body), lower(e0)) AS bad, t.best FROM r1 LEFT JOIN told t ON t.item_id = r1.item_id AND t.label = l1),
 r3 AS (SELECT *, CASE WHEN l1 IS NULL THEN NULL WHEN bad THEN best ELSE e0 END AS e1 FROM r2),
 r4 AS (SELECT *, CASE WHEN e1 IS NULL THEN NULL WHEN {fits('l1', 'e1')} THEN l1 ELSE {remap('e1')} END AS label, e1 IS NOT NULL AND NOT {fits('l1', 'e1')} AS again, e1 AS evidence FROM r3),
 r_fixes AS (SELECT item_id, flatten(list({_FIXES} ORDER BY pos)) AS fixes FROM r4 GROUP BY 1),
 r5 AS (SELECT item_id, body, pos, label, evidence FROM r4 WHERE label IS NOT NULL), {best_of_labels('r5', 'rep', rank('label'))},
 repaired AS (SELECT item_id, list({{'label': label, 'evidence': evidence}} ORDER BY met) AS pairs FROM rep_3 GROUP BY 1),
 w0 AS (SELECT v.*, CASE WHEN NOT fix THEN NULL WHEN len(detail) = 0 THEN coalesce(m.pairs, []) ELSE coalesce(r.pairs, []) END AS rp, CASE WHEN len(detail) = 0 THEN CASE WHEN m.pairs IS NOT NULL THEN ['filled'] ELSE [] END ELSE coalesce(f.fixes, []) END AS rf FROM v3 v LEFT JOIN mined m USING (item_id) LEFT JOIN repaired r USING (item_id) LEFT JOIN r_fixes f USING (item_id)),
 w1 AS (SELECT item_id, src AS body, rp FROM w0 WHERE fix), {exploded('w1', 'rp', 'w2')}, {sanitized('w2', 'clean')},
 x0 AS (SELECT w.*, coalesce(c.pairs, []) AS cp, fix AND list_contains(errors_0, 'SIGNALS_MISSING') AND len(retry_detail) > 0 AS retried, list_has_any(errors_0, ['KEY_MISALIGNED', 'CLUSTER_MISALIGNED']) AS rekeyed FROM w0 w LEFT JOIN clean c USING (item_id)),
 x1 AS (SELECT * EXCLUDE (detail, importance, malformed, dedupe_key, cluster_key), CASE WHEN retried THEN retry_detail WHEN fix THEN cp ELSE detail END AS detail, CASE WHEN retried AND retry_importance <> 0 THEN greatest(1, least(5, retry_importance)) ELSE importance END AS importance, malformed AND NOT fix AS malformed,
  CASE WHEN rekeyed THEN rule_key ELSE dedupe_key END AS dedupe_key, CASE WHEN rekeyed THEN rule_cluster ELSE cluster_key END AS cluster_key, CASE WHEN fix THEN list_concat(rf, {some(["CASE WHEN cp <> rp THEN 'sanitised' END", "CASE WHEN rekeyed THEN 'new_keys' END", "CASE WHEN retried THEN 'second_judgment' END"])}) ELSE [] END AS fixes FROM x0),
 {checked_sql('x1', 'errors_1')}, x3 AS (SELECT *, list_contains(errors_1, 'SIGNALS_MISSING') AS lost FROM errors_1_step),
 x4 AS (SELECT *, NOT lost AND list_has_any(errors_1, {_FIXABLE}) AND NOT list_has_any(errors_1, ['OUTDATED', 'STALE_INCIDENT']) AND len(detail) > 0 AS clear FROM x3),
 x5 AS (SELECT * EXCLUDE (detail), CASE WHEN clear THEN []::{_PAIRS} ELSE detail END AS detail FROM x4), {checked_sql('x5', 'again_2')}, x6 AS (SELECT *, CASE WHEN clear THEN again_2 ELSE errors_1 END AS errors_2 FROM again_2_step),
 x7 AS (SELECT *, CASE WHEN lost THEN 'signals_missing' WHEN list_contains(errors_2, 'STALE_INCIDENT') THEN 'stale_incident' WHEN list_contains(errors_2, 'OUTDATED') THEN 'outdated' WHEN list_has_any(errors_2, {_FIXABLE}) THEN 'validation_error' END AS drop_reason,
  NOT lost AND list_contains(errors_2, 'LOW_QUALITY_MISMATCH') AS low, NOT lost AND list_contains(errors_2, 'SIGNALS_REQUIRED') AS bare_, CASE WHEN clear THEN list_append(fixes, 'signals_cleared') ELSE fixes END AS all_fixes FROM x6),
 x8 AS (SELECT *, CASE WHEN low AND importance > 2 THEN 2 WHEN low AND importance > 1 THEN 1 ELSE importance END AS lowered FROM x7),
 validated AS (SELECT item_id, errors_0, errors_1, errors_2, all_fixes AS fixes, drop_reason, CASE WHEN drop_reason IS NOT NULL THEN 'dropped' WHEN len(all_fixes) > 0 THEN 'modified' ELSE 'kept' END AS action, CASE WHEN bare_ AND lowered >= 3 THEN 2 ELSE lowered END AS importance,
  CASE WHEN lost THEN 'low_quality' ELSE quality END AS quality, CASE WHEN lost AND quality_reason = '' THEN 'signals_missing' WHEN low AND quality_reason = '' THEN '{CFG.quality_low_reason}' ELSE quality_reason END AS quality_reason, detail, dedupe_key, cluster_key FROM x8)"""


def checked(spark, sf_dir) -> DataFrame:
    """Planted rows with their errors handled. They are staged before: the folds of keys would otherwise be computed again at each check."""
    rows = dedupe.stored(planted(spark, sf_dir).select("item_id", "title", "summary", "full_text", "detail", "dedupe_key", "cluster_key", "importance", "quality", "quality_reason", "why", "rationale", "malformed", "outdated", "stale", "retry_detail", "retry_importance"))
    return validation.handled(rows, CFG)


@query(f"""{VALIDATED} SELECT item_id, array_to_string(errors_0, ',') AS errors_0, array_to_string(errors_1, ',') AS errors_1, array_to_string(errors_2, ',') AS errors_2, array_to_string(fixes, ',') AS fixes, action, drop_reason, importance, quality, quality_reason,
 {_shown_sql('detail')} AS detail, dedupe_key, cluster_key FROM validated""")
def validated(spark, sf_dir):
    """VAL-1, VAL-2, KEY-4, FLT-15: planted errors of every kind, their fixes, and what becomes of each row."""
    df = checked(spark, sf_dir)
    return df.select("item_id", *(F.array_join(c, ",").alias(c) for c in ("errors_0", "errors_1", "errors_2", "fixes")), "action", "drop_reason", "importance", "quality", "quality_reason", _shown("detail").alias("detail"), "dedupe_key", "cluster_key")


@query(f"""{VALIDATED}, both_ AS (SELECT *, unnest(['first', 'second']) AS run_id FROM validated)
SELECT run_id, action AS final_action, count(*) AS n, sum(len(fixes))::BIGINT AS n_fixes, sum(len(errors_0))::BIGINT AS n_errors, sum(len(errors_2))::BIGINT AS n_left, count(CASE WHEN list_contains(fixes, 'relabelled') THEN 1 END) AS relabelled FROM both_ GROUP BY ALL""")
def validation_log(spark, sf_dir):
    """SNK-5: the log of two runs, appended and read again: errors before and after, fixes, action."""
    rows, path = dedupe.stored(checked(spark, sf_dir)), _folder(spark)
    for run in ("first", "second"):
        sinks.append_log(validation.log_rows(rows, run), path)
    back = spark.read.schema(validation.log_rows(rows, "").schema).parquet(path)
    size = lambda c: F.sum(F.size(c)).alias
    return back.groupBy("run_id", "final_action").agg(F.count("*").alias("n"), size("auto_fixed")("n_fixes"), size("original_errors")("n_errors"), size("remaining_errors")("n_left"), F.count_if(F.array_contains("auto_fixed", "relabelled")).alias("relabelled"))


# editions with one planted fault of each kind

#: What is wrong with an edition, by its number.
FAULTS = ("none", "key", "field", "old", "incident", "quality", "format", "label", "evidence", "unknown", "empty", "short", "invalid", "bare", "few", "many")
OLD_FIRE = "A trash fire on 2023-01-15 is told again"


def editions(spark, sf_dir, faults: bool = True) -> DataFrame:
    """Editions of twelve documents each; every sixteenth has three and the next one the others. One row of each has the edition's fault."""
    k, g = F.col("item_id"), F.floor(F.col("item_id") / 12)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "source")
    docs = docs.withColumn("edition", F.when((g % 16 == 14) & (k % 12 >= 3), g + 1).otherwise(g).cast("int"))
    bad = lambda name: (F.get(tk.lit_array(FAULTS), F.col("edition") % 16) == name) & (k % 12 == 1) & F.lit(faults)
    pair = lambda label, e: F.struct(F.lit(label).alias("label"), F.lit(e).alias("evidence"))
    sound = pair("security", SAYS[0])
    detail = F.when(bad("label"), F.array(sound, pair("security", SAYS[1]))).when(bad("evidence"), F.array(sound, pair("market-demand", SAYS[0].upper()))).when(bad("unknown"), F.array(pair("budget", SAYS[0]))).when(bad("empty"), F.array(pair("policy", ""))).when(bad("short"), F.array(pair("policy", "license"))).when(bad("invalid"), F.array(sound, pair("earnings", SAYS[1]))).when(bad("bare"), sg.pairs()).otherwise(F.array(sound))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("edition"))
    return docs.select(
        "item_id", "edition", F.date_format(day, "yyyy-MM-dd").alias("date"), k.cast("string").alias("id"), F.lit("economy").alias("category"), F.when(bad("incident"), OLD_FIRE).otherwise(F.concat(F.lit("Title "), k.cast("string"))).alias("title"),
        F.array(F.lit("One line of it.")).alias("lines"), F.when(~bad("field"), "why").alias("why"), F.lit("because").alias("rationale"), detail.alias("detail"), F.concat(F.lit("key-"), F.when(bad("key"), k - 1).otherwise(k).cast("string")).alias("dedupe_key"),
        F.col("source").alias("source_name"), F.lit("https://a.example/x").alias("source_url"), (day.cast("timestamp") + F.when(bad("old"), F.expr("INTERVAL -4 DAYS")).otherwise(F.expr("INTERVAL 1 HOUR"))).alias("published_at"), F.lit("kept").alias("status"), F.lit(3).alias("importance"),
        F.when(bad("quality"), "low_quality").otherwise("ok").alias("quality"), F.lit("informative").alias("quality_reason"), bad("format").alias("malformed"), k.alias("pos"),
    )


_SAY = [f"'{x}'" for x in SAYS]
_FAULT = lambda name: f"({listed(FAULTS)}[edition % 16 + 1] = '{name}' AND item_id % 12 = 1)"
_SOUND = struct_sql("'security'", _SAY[0])
EDITIONS = f"""WITH e0 AS (SELECT doc_id AS item_id, CASE WHEN doc_id // 12 % 16 = 14 AND doc_id % 12 >= 3 THEN doc_id // 12 + 1 ELSE doc_id // 12 END AS edition FROM documents),
 e1 AS (SELECT *, strftime(DATE '2024-01-01' + edition::INT, '%Y-%m-%d') AS date, CASE WHEN {_FAULT('incident')} THEN '{OLD_FIRE}' ELSE 'Title ' || item_id END AS title, CASE WHEN {_FAULT('key')} THEN item_id - 1 ELSE item_id END AS own_key, CASE WHEN {_FAULT('field')} THEN NULL ELSE 'why' END AS why,
  TIMESTAMP '2024-01-01 00:00:00' + edition * INTERVAL 1 DAY + CASE WHEN {_FAULT('old')} THEN INTERVAL (-96) HOUR ELSE INTERVAL 1 HOUR END AS published_at, CASE WHEN {_FAULT('quality')} THEN 'low_quality' ELSE 'ok' END AS quality, {_FAULT('format')} AS malformed,
  (CASE WHEN {_FAULT('label')} THEN [{_SOUND}, {struct_sql("'security'", _SAY[1])}] WHEN {_FAULT('evidence')} THEN [{_SOUND}, {struct_sql("'market-demand'", f'upper({_SAY[0]})')}] WHEN {_FAULT('unknown')} THEN [{struct_sql("'budget'", _SAY[0])}] WHEN {_FAULT('empty')} THEN [{struct_sql("'policy'", "''")}] WHEN {_FAULT('short')} THEN [{struct_sql("'policy'", "'license'")}]
   WHEN {_FAULT('invalid')} THEN [{_SOUND}, {struct_sql("'earnings'", _SAY[1])}] WHEN {_FAULT('bare')} THEN [] ELSE [{_SOUND}] END)::{_PAIRS} AS detail FROM e0),
 e2 AS (SELECT *, try_cast(nullif(regexp_extract(title, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), '') AS DATE) AS told_day, list_filter(list_transform(detail, lambda x: {evidence_key('x.evidence')}), lambda x: x <> '') AS keys FROM e1),
 e3 AS (SELECT *, CASE WHEN why IS NULL THEN 'MISSING_FIELD' WHEN abs(epoch(published_at) - (epoch(date::DATE) - 9 * 3600)) > 72 * 3600 THEN 'OUTDATED' WHEN {said('title', CFG.incident_words)} AND told_day < date::DATE - 90 THEN 'STALE_INCIDENT' WHEN quality = 'low_quality' THEN 'LOW_QUALITY_MISMATCH' WHEN malformed THEN 'BAD_FORMAT'
  WHEN len(list_distinct(list_transform(detail, lambda x: x.label))) < len(detail) THEN 'DUPLICATE_LABEL' WHEN len(list_distinct(keys)) < len(keys) THEN 'DUPLICATE_EVIDENCE'
  ELSE coalesce(list_filter(list_transform(detail, lambda x: CASE WHEN NOT {known('x.label')} THEN 'UNKNOWN_LABEL' WHEN x.evidence = '' THEN 'EVIDENCE_REQUIRED' WHEN {short('x.evidence')} THEN 'SHORT_EVIDENCE' WHEN NOT {fits('x.label', 'x.evidence')} THEN 'INVALID_' || upper(x.label) END), lambda x: x IS NOT NULL)[1], CASE WHEN len(detail) = 0 THEN 'SIGNALS_REQUIRED' END) END AS code FROM e2),
 checked AS (SELECT date, count(*) AS n_items, CASE WHEN count(*) < 5 THEN 'TOO_FEW_ITEMS' WHEN count(*) > {CFG.top_limit} THEN 'TOO_MANY_ITEMS' WHEN count(DISTINCT own_key) < count(*) THEN 'DUPLICATE_KEY' ELSE coalesce(arg_min(code, item_id) FILTER (code IS NOT NULL), 'ok') END AS code FROM e3 GROUP BY 1)"""


@query(f"{EDITIONS} SELECT date, n_items, code, code = 'ok' AS valid FROM checked")
def digest_valid(spark, sf_dir):
    """VAL-3: size, keys, sixteen fields and every row's rules over editions with a planted fault of each kind."""
    return validation.editions_valid(editions(spark, sf_dir), CFG)


@query(f"""{EDITIONS}, ok AS (SELECT date FROM checked WHERE code IN ('ok', 'TOO_FEW_ITEMS')), many AS (SELECT date FROM checked WHERE code = 'TOO_MANY_ITEMS'), n AS (SELECT date, edition, count(*) AS n FROM e0 JOIN (SELECT DISTINCT date, edition FROM e1) USING (edition) GROUP BY ALL)
SELECT n.date, CASE WHEN n.date IN (SELECT date FROM ok) THEN CASE WHEN edition % 2 = 0 THEN 'fourth' ELSE 'second' END ELSE 'first' END AS run, CASE WHEN n.date IN (SELECT date FROM many) THEN {CFG.top_limit} ELSE n.n END AS n_items, 'run ' || CASE WHEN n.date IN (SELECT date FROM ok) THEN CASE WHEN edition % 2 = 0 THEN 'fourth' ELSE 'second' END ELSE 'first' END AS note FROM n""")
def published_editions(spark, sf_dir):
    """SNK-1, SNK-6: editions go out, later ones with too many rows keep what was there, one with a broken row swaps nothing, and a sound one replaces some dates as one."""
    path, rows = _folder(spark), dedupe.stored(editions(spark, sf_dir))
    header = lambda run: {"note": F.lit(f"run {run}"), "updated_at": F.col("date")}
    sound = dedupe.stored(editions(spark, sf_dir, faults=False).withColumn("place", F.row_number().over(Window.partitionBy("date").orderBy("pos"))))
    sinks.swap_editions(sound.where(F.col("place") <= CFG.top_limit).drop("place"), path, "first", header("first"), CFG)
    verdict = validation.editions_valid(rows, CFG)
    good = rows.join(verdict.where("code IN ('ok', 'TOO_FEW_ITEMS', 'TOO_MANY_ITEMS')").select("date"), "date", "left_semi")
    sinks.swap_editions(good, path, "second", header("second"), CFG)
    try:
        sinks.swap_editions(rows, path, "third", header("third"), CFG)
    except sinks.BrokenEdition:
        pass
    sinks.swap_editions(good.where("edition % 2 = 0"), path, "fourth", header("fourth"), CFG)
    back = sinks.read_editions(spark, path)
    return back.select("date", "run", F.size("items").cast("long").alias("n_items"), "note")
