"""Impact signals and scores: what a text says, how well its evidence holds, what it is worth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.text import Lowered, Said, bound, collapse, lowered, mentions, normalize_source, sentences
from gazette.functions.tokens import lit_array

PAIR = "array<struct<label:string,evidence:string>>"


def pairs(*values) -> Column:
    return F.array(*values) if values else F.array().cast(PAIR)


def keywords(cfg: Config) -> dict[str, tuple[str, ...]]:
    return dict(cfg.signals)


def vocabulary(cfg: Config) -> tuple[str, ...]:
    """All keywords that rule_signals() and long_labels() look for, in lower case."""
    lists = (*(words for _, words in (*cfg.signals, *cfg.long_triggers)), cfg.trade_words, cfg.sanctions_words)
    return tuple(dict.fromkeys(w.lower() for words in lists for w in words))


def rule_signals(text: Column | Lowered | Said, cfg: Config) -> Column:
    """All labels whose keywords occur, in the order of the vocabulary. Trade words add two labels; sanctions need explicit words."""
    flags = []
    for label, words in cfg.signals:
        hit = mentions(text, words)
        if label in ("policy", "market-demand"):
            hit = hit | mentions(text, cfg.trade_words)
        if label == "sanctions":
            hit = mentions(text, cfg.sanctions_words)
        flags.append(F.when(hit, F.lit(label)))
    return F.array_compact(F.array(*flags)) if flags else lit_array(())


def impact_signals(text: Column | Lowered | Said, cfg: Config) -> Column:
    return F.slice(rule_signals(text, cfg), 1, 2)


def long_labels(text: Column | Lowered | Said, signals: Column, cfg: Config) -> Column:
    """Those of the row's labels whose long-run phrases occur."""
    flags = [F.when(mentions(text, words), F.lit(label)) for label, words in cfg.long_triggers]
    return F.array_intersect(signals, F.array_compact(F.array(*flags))) if flags else lit_array(())


def has_number(c: Column) -> Column:
    return c.rlike("[0-9]")


def hits(evidence: Column, label: str, cfg: Config) -> Column:
    low = F.lower(evidence)
    return F.size(F.filter(lit_array([k.lower() for k in keywords(cfg).get(label, ())]), lambda k: F.contains(low, k)))


def _holds(label: str, low: Lowered, number: Column, cfg: Config) -> Column:
    """Whether a sentence, in lower case, with or without a number, supports a label. Every label needs a keyword; some need more."""
    found = mentions(low, keywords(cfg).get(label, ()))
    if label == "policy":
        weak = mentions(low, cfg.trade_words) & ~mentions(low, cfg.policy_action)
        return found & ~(weak & ~mentions(low, cfg.government))
    if label == "sanctions":
        return mentions(low, cfg.sanctions_words)
    if label == "earnings":
        return found & number
    if label == "capex":
        return found & (mentions(low, cfg.policy_action) | number)
    return found


def _read(evidence: Column) -> Column:
    return F.struct(lowered(evidence).alias("low"), has_number(evidence).alias("number"))


def evidence_valid(label: str, evidence: Column, cfg: Config) -> Column:
    return bound(_read(evidence), lambda x: _holds(label, Lowered(x["low"]), x["number"], cfg))


def valid_pair(label: Column, evidence: Column, cfg: Config) -> Column:
    def of(x: Column) -> Column:
        out = F.lit(False)
        for name, _ in cfg.signals:
            out = F.when(x["label"] == name, _holds(name, Lowered(x["e"]["low"]), x["e"]["number"], cfg)).otherwise(out)
        return out

    return bound(F.struct(label.alias("label"), _read(evidence).alias("e")), of)


def told_sentences(parts: Column, cfg: Config) -> Column:
    """Each sentence with whether it is too short and which labels it holds for, found once for all labels."""
    held = lambda x: F.struct(*(_holds(label, Lowered(x["low"]), x["number"], cfg).alias(label) for label in dict.fromkeys((*keywords(cfg), *cfg.export_order))))
    return F.transform(parts, lambda s: F.struct(s.alias("s"), too_short(s).alias("short"), bound(_read(s), held).alias("holds")))


def specificity(label: Column, evidence: Column, cfg: Config) -> Column:
    """(length, has a number, keyword hits): larger is more specific."""
    n = F.lit(0)
    for name, _ in cfg.signals:
        n = F.when(label == name, hits(evidence, name, cfg)).otherwise(n)
    return F.struct(F.length(evidence).alias("length"), has_number(evidence).cast("int").alias("number"), n.alias("hits"))


def evidence_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9가-힣]+", " "))


def too_short(c: Column) -> Column:
    """Under 20 characters or 6 words. A long text is read only as far as its sixth word."""
    return (F.length(c) < 20) | ~c.rlike(r"^\s*+(?:\S++\s++){5}\S")


def best_per_label(found: Column, cfg: Config) -> Column:
    """The most specific evidence of each label; labels by that; a repeated evidence goes."""
    scored = F.transform(found, lambda x: F.struct(specificity(x["label"], x["evidence"], cfg).alias("s"), x["label"].alias("label"), x["evidence"].alias("evidence")))
    ranked = F.reverse(F.array_sort(scored))
    empty = F.struct(lit_array(()).alias("labels"), lit_array(()).alias("keys"), pairs().alias("out"))

    def step(acc: Column, x: Column) -> Column:
        key = evidence_key(x["evidence"])
        fresh = ~F.array_contains(acc["labels"], x["label"]) & ~F.array_contains(acc["keys"], key)
        item = F.struct(x["label"].alias("label"), x["evidence"].alias("evidence"))
        return F.struct(
            F.when(fresh, F.array_append(acc["labels"], x["label"])).otherwise(acc["labels"]).alias("labels"),
            F.when(fresh, F.array_append(acc["keys"], key)).otherwise(acc["keys"]).alias("keys"),
            F.when(fresh, F.array_append(acc["out"], item)).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(ranked, empty, step, lambda acc: acc["out"])


def _ranked(found: Column, cfg: Config) -> Column:
    """Each pair with what it is sorted by: longer, with a number, more keywords, earlier."""

    def one(x: Column, i: Column) -> Column:
        s = specificity(x["label"], x["evidence"], cfg)
        return F.struct((-s["length"]).alias("l"), (-s["number"]).alias("n"), (-s["hits"]).alias("h"), i.alias("i"), x["label"].alias("label"), x["evidence"].alias("evidence"))

    return F.transform(found, one)


def one_per_label(found: Column, cfg: Config) -> Column:
    """The most specific pair of each label, in the order in which the labels first occur."""

    def best(ranked: Column) -> Column:
        def of(label: str) -> Column:
            mine = lambda r: F.filter(r, lambda x: x["label"] == label)
            return bound(mine(ranked), lambda m: F.when(F.size(m) > 0, F.struct(F.array_min(F.transform(m, lambda x: x["i"])).alias("first"), F.array_min(m).alias("best"))))

        return F.transform(F.array_sort(F.array_compact(F.array(*(of(label) for label, _ in cfg.signals)))), lambda x: x["best"])

    return F.transform(bound(_ranked(found, cfg), best), lambda x: F.struct(x["label"].alias("label"), x["evidence"].alias("evidence")))


def unique_evidence(found: Column) -> Column:
    """The first pair of each evidence; a pair without one goes."""
    keyed = F.transform(found, lambda x: F.struct(evidence_key(x["evidence"]).alias("k"), x.alias("pair")))
    kept = bound(keyed, lambda ks: bound(F.transform(ks, lambda x: x["k"]), lambda keys: F.filter(ks, lambda x, i: (x["k"] != "") & (F.array_position(keys, x["k"]) == i + 1))))
    return F.transform(kept, lambda x: x["pair"])


def stands_in(evidence: Column, text: Column | Lowered) -> Column:
    """Whether a text holds the evidence, whatever the case."""
    return F.contains(text.column if isinstance(text, Lowered) else F.lower(text), F.lower(evidence))


def sanitized(found: Column, full_text: Column, cfg: Config) -> Column:
    """Allowed label, evidence long enough, standing in the text and valid; the best of each label, the most specific first, each evidence once. Without a text: nothing."""
    good = bound(F.lower(full_text), lambda low: F.filter(found, lambda x: x["label"].isin(*keywords(cfg)) & ~too_short(x["evidence"]) & stands_in(x["evidence"], Lowered(low)) & valid_pair(x["label"], x["evidence"], cfg)))

    def ordered(best: Column) -> Column:
        ranked = F.array_sort(_ranked(best, cfg))
        return unique_evidence(F.transform(ranked, lambda x: F.struct(x["label"].alias("label"), x["evidence"].alias("evidence"))))

    return F.when(F.length(F.coalesce(full_text, F.lit(""))) > 0, bound(one_per_label(good, cfg), ordered)).otherwise(pairs())


def best_sentence(told: Column, label: str, cfg: Config) -> Column:
    """The most specific of told_sentences() that holds for a label and is long enough; null without any."""
    good = F.filter(told, lambda v: v["holds"][label] & ~v["short"])
    ranked = F.transform(good, lambda v, i: F.struct((-F.length(v["s"])).alias("l"), (-has_number(v["s"]).cast("int")).alias("n"), (-hits(v["s"], label, cfg)).alias("h"), i.alias("i"), v["s"].alias("s")))
    return F.array_min(ranked)["s"]


def _with_neighbour(told: Column, label: str, cfg: Config) -> Column:
    """A valid sentence that is too short, joined with the next one or else the one before; the first that gives enough."""

    def one(v: Column, i: Column) -> Column:
        after, before = F.concat_ws(" ", v["s"], F.get(told, i + 1)["s"]), F.concat_ws(" ", F.get(told, i - 1)["s"], v["s"])
        holds = lambda c, there: there & ~too_short(c) & evidence_valid(label, c, cfg)
        joined = F.when(holds(after, i + 1 < F.size(told)), after).when(holds(before, i > 0), before)
        return F.when(v["holds"][label], F.when(~v["short"], v["s"]).otherwise(joined))

    return F.get(F.array_compact(F.transform(told, one)), F.lit(0))


def mined(text: Column, cfg: Config) -> Column:
    """Pairs mined from the text: each label whose keywords occur, in export order, with its best sentence, a short one with its neighbour; where that gives nothing, the first label that has any evidence."""

    def of_text(x: Column) -> Column:
        evidence = {label: F.coalesce(best_sentence(x["told"], label, cfg), _with_neighbour(x["told"], label, cfg)) for label in cfg.export_order}
        pair = lambda label, e: F.when(e.isNotNull(), F.struct(F.lit(label).alias("label"), e.alias("evidence")))
        found = F.struct(*(e.alias(label) for label, e in evidence.items()))

        def chosen(t: Column) -> Column:
            said = F.array_compact(F.array(*(F.when(mentions(Lowered(x["low"]), keywords(cfg).get(label, ())) | F.lit(not keywords(cfg).get(label)), pair(label, t[label])) for label in cfg.export_order)))
            last = F.array_compact(F.array(F.coalesce(*(pair(label, t[label]) for label in cfg.export_order))))
            return bound(said, lambda s: F.when(F.size(s) > 0, s).otherwise(last))

        return bound(found, chosen)

    flat = collapse(F.coalesce(text, F.lit("")))
    read = bound(flat, lambda c: F.struct(told_sentences(sentences(c), cfg).alias("told"), F.lower(c).alias("low")))
    return bound(bound(read, of_text), lambda found: sanitized(found, text, cfg))


def _clean(c: Column) -> Column:
    return collapse(F.coalesce(c, F.lit("")))


def given_pairs(raw: Column, labels: Column) -> Column:
    """Pairs that a judgment's JSON gives, in the first of three forms that gives any.

    detail: objects with label and evidence; else signals: the same; else signals as labels (or the
    row's own labels where it has none) and evidence: a map from label to evidence. Entries that
    aren't what the form asks for, and pairs without label or evidence, go. No JSON: no pairs.
    """
    v = F.try_parse_json(raw)
    listed = lambda path: F.try_variant_get(v, path, "array<variant>")
    text = lambda x, path: F.try_variant_get(x, path, "string")
    full = lambda xs: F.filter(F.coalesce(xs, pairs()), lambda x: (x["label"] != "") & (x["evidence"] != ""))
    objects = lambda path: full(F.transform(listed(path), lambda x: F.struct(F.lower(_clean(text(x, "$.label"))).alias("label"), _clean(text(x, "$.evidence")).alias("evidence"))))
    is_object = F.try_variant_get(F.get(listed("$.signals"), F.lit(0)), "$", "map<string,variant>").isNotNull()
    said = F.filter(F.transform(listed("$.signals"), lambda x: text(x, "$")), lambda x: x.isNotNull())
    told = F.try_variant_get(v, "$.evidence", "map<string,variant>")
    named = bound(F.when(F.coalesce(F.size(said), F.lit(0)) > 0, said).otherwise(F.coalesce(labels, lit_array(()))), lambda ls: F.transform(ls, lambda x: F.struct(F.lower(_clean(x)).alias("label"), _clean(text(F.try_element_at(told, x), "$")).alias("evidence"))))
    forms = F.array(objects("$.detail"), F.when(is_object, objects("$.signals")).otherwise(pairs()), F.when(is_object, pairs()).otherwise(full(named)))
    return F.coalesce(F.get(F.filter(forms, lambda x: F.size(x) > 0), F.lit(0)), pairs())


def signal_detail(given: Column, full_text: Column, cfg: Config) -> Column:
    """Given pairs, sanitised; evidence mined from the text where none holds."""
    return bound(sanitized(given, full_text, cfg), lambda good: F.when(F.size(good) > 0, good).otherwise(mined(full_text, cfg)))


def remapped(evidence: Column, cfg: Config) -> Column:
    """The first label, in export order, that an evidence holds for."""
    return F.coalesce(*(F.when(evidence_valid(label, evidence, cfg), F.lit(label)) for label in cfg.export_order))


def repaired(found: Column, full_text: Column, cfg: Config) -> Column:
    """struct(pairs, fixes): pairs with a label that fits their evidence and evidence that stands in the text.

    A label that isn't allowed gives way to one that the evidence holds for; evidence that is
    short or not in the text gives way to the label's best sentence there; a pair that still
    doesn't hold gets the label that its evidence does hold for, or goes. One pair stays per label,
    the most specific, and per evidence, the one whose label is exported first. Without any pair
    the text is mined.
    """

    def all_of(x: Column) -> Column:
        text, low = x["text"], Lowered(x["low"])
        sentence = bound(told_sentences(sentences(text), cfg), lambda told: F.create_map(*[c for label, _ in cfg.signals for c in (F.lit(label), best_sentence(told, label, cfg))]))

        def one(p: Column, best: Column) -> Column:
            known = p["label"].isin(*keywords(cfg))
            first = F.struct(F.when(known, p["label"]).otherwise(remapped(p["evidence"], cfg)).alias("label"), p["evidence"].alias("evidence"), (~known).alias("relabelled"))

            def sound(a: Column) -> Column:
                bad = (a["evidence"] == "") | too_short(a["evidence"]) | ~stands_in(a["evidence"], low)
                return F.struct(a["label"].alias("label"), F.when(bad, F.try_element_at(best, a["label"])).otherwise(a["evidence"]).alias("evidence"), a["relabelled"].alias("relabelled"), bad.alias("replaced"))

            def fitting(b: Column) -> Column:
                holds = valid_pair(b["label"], b["evidence"], cfg)
                return F.struct(F.when(holds, b["label"]).otherwise(remapped(b["evidence"], cfg)).alias("label"), b["evidence"].alias("evidence"), b["relabelled"].alias("relabelled"), b["replaced"].alias("replaced"), (~holds).alias("again"))

            none = F.lit(None).cast("string")
            lost = lambda b: F.struct(none.alias("label"), none.alias("evidence"), b["relabelled"].alias("relabelled"), b["replaced"].alias("replaced"), F.lit(False).alias("again"))
            return bound(bound(first, lambda a: F.when(a["label"].isNotNull(), sound(a))), lambda b: F.when(b["evidence"].isNotNull(), fitting(b)).when(b["label"].isNotNull(), lost(b)))

        tried = bound(sentence, lambda best: F.transform(found, lambda p: one(p, best)))

        def kept(ts: Column) -> Column:
            good = F.transform(F.filter(ts, lambda t: t["label"].isNotNull()), lambda t: F.struct(t["label"].alias("label"), t["evidence"].alias("evidence")))
            place = {label: k for k, label in enumerate(cfg.export_order)}
            by_rank = lambda ps: F.transform(F.array_sort(F.transform(ps, lambda p: F.struct(F.coalesce(*(F.when(p["label"] == label, F.lit(k)) for label, k in place.items()), F.lit(99)).alias("k"), p.alias("p")))), lambda y: y["p"])
            first = bound(one_per_label(good, cfg), lambda ps: F.transform(F.array_sort(F.transform(unique_evidence(by_rank(ps)), lambda p: F.struct(F.array_position(F.transform(ps, lambda q: evidence_key(q["evidence"])), evidence_key(p["evidence"])).alias("at"), p.alias("p")))), lambda y: y["p"]))
            fixes = F.flatten(F.transform(ts, lambda t: F.array_compact(F.array(F.when(t["relabelled"], "relabelled"), F.when(t["replaced"] & t["evidence"].isNotNull(), "replaced_evidence"), F.when(t["again"] & t["label"].isNotNull(), "relabelled")))))
            return F.struct(first.alias("pairs"), F.coalesce(fixes, lit_array(())).alias("fixes"))

        filled = bound(mined(text, cfg), lambda m: F.struct(m.alias("pairs"), F.when(F.size(m) > 0, F.array(F.lit("filled"))).otherwise(lit_array(())).alias("fixes")))
        return F.when(F.size(found) == 0, filled).otherwise(bound(tried, kept))

    flat = collapse(F.coalesce(full_text, F.lit("")))
    return bound(bound(flat, lambda c: F.struct(c.alias("text"), F.lower(c).alias("low"))), all_of)


def judged_pairs(given: Column, candidates: Column, full_text: Column, cfg: Config) -> Column:
    """Judged pairs whose label is a candidate and whose evidence stands in the text and holds; two labels, sanctions forced in."""
    good = F.filter(given, lambda x: F.array_contains(candidates, x["label"]) & F.contains(full_text, x["evidence"]) & valid_pair(x["label"], x["evidence"], cfg))
    is_first = lambda x: x["label"] == "sanctions"
    return bound(best_per_label(good, cfg), lambda best: F.slice(F.concat(F.filter(best, is_first), F.filter(best, lambda x: ~is_first(x))), 1, 2))


def merged_labels(rule: Column, judged: Column, text: Column, cfg: Config) -> Column:
    """Rule labels, then judged ones whose keywords occur in the text."""
    return F.array_distinct(F.concat(rule, F.array_intersect(judged, rule_signals(text, cfg))))


def source_weight(source: Column, cfg: Config) -> Column:
    """By tier of the outlet, under its own name or the normalised one."""
    low = F.lower(F.coalesce(source, F.lit("")))
    short = lambda c: F.lower(normalize_source(c, cfg))
    listed = lambda names: low.isin(*names) | short(low).isin(*(short(F.lit(n)) for n in names))
    return F.when(listed(cfg.tier_a), 3.0).when(listed(cfg.tier_b), 1.5).otherwise(0.3)


def source_boost(weight: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (weight - 0.3) / 2.7)) * 0.6


def score(signals: Column, longs: Column, seconds: Column, boost: Column) -> Column:
    has = lambda *labels: F.arrays_overlap(F.array_except(signals, longs), lit_array(labels))
    part = lambda cond, x: F.when(cond, F.lit(x)).otherwise(F.lit(0.0))
    level = part(F.size(longs) > 0, 3.0) + part(has("capex", "infra", "security"), 2.0) + part(has("policy", "sanctions"), 1.0) + part(F.arrays_overlap(signals, lit_array(("earnings", "market-demand"))), 1.0)
    return level + part(seconds <= 20, 0.5) + boost


def judged_score(value: Column, importance: Column, weight: float = 1.0) -> Column:
    return F.greatest(F.lit(0.0), value + (F.coalesce(importance, F.lit(3)) - 3) * weight)


def inferred_importance(signals: Column, longs: Column, cfg: Config) -> Column:
    """4 with a long-run phrase, 2 for policy and sanctions without one, else the label's level; 1 without labels."""
    levels = dict(cfg.base_levels)

    def level(x: Column) -> Column:
        out = F.lit(2)
        for label, _ in cfg.signals:
            out = F.when(x == label, 2 if label in ("policy", "sanctions") else levels.get(label, 2)).otherwise(out)
        return F.when(F.array_contains(longs, x), 4).otherwise(out)

    return F.coalesce(F.array_max(F.transform(signals, level)), F.lit(1))
