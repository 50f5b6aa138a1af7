"""Tokens and keys: array expressions over one row, no Python workers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.text import bound

HANGUL = "가-힣"


def lit_array(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def raw_tokens(c: Column) -> Column:
    """Lower case; everything but letters a-z, digits and Hangul is a gap."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), f"[^a-z0-9{HANGUL}]+"), lambda x: x != "")


def valid_length(t: Column) -> Column:
    return (F.length(t) >= 3) | ((F.length(t) >= 2) & t.rlike(f"[{HANGUL}]"))


def ends_in(t: Column, endings: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.endswith(t, F.lit(e)) for e in endings), F.lit(False))


def normal_token(t: Column, cfg: Config) -> Column:
    """Alias, then up to three endings off (the longest that leaves two letters); a stopword becomes empty."""
    known = F.create_map(*[F.lit(x) for pair in cfg.aliases for x in pair]) if cfg.aliases else None
    t = F.coalesce(F.try_element_at(known, t), t) if known is not None else t

    def cut(x: Column) -> Column:
        out = x
        for e in sorted(cfg.endings, key=len):
            out = F.when(F.endswith(x, F.lit(e)) & (F.length(x) >= len(e) + 2), F.substring(x, F.lit(1), F.length(x) - len(e))).otherwise(out)
        return F.when(ends_in(x, cfg.endings), out).otherwise(x)

    for _ in range(3):
        t = bound(t, cut)
    return bound(t, lambda x: F.when(x.isin(*cfg.stopwords) | ~valid_length(x), "").otherwise(x))


def normal_of(raw: Column, cfg: Config) -> Column:
    """The distinct normal forms of raw tokens, in order."""
    return F.array_distinct(F.filter(F.transform(F.array_distinct(raw), lambda t: normal_token(t, cfg)), lambda t: t != ""))


def normal_tokens(c: Column, cfg: Config) -> Column:
    """The distinct normal tokens of a text, in order."""
    return normal_of(raw_tokens(c), cfg)


def is_date_like(t: Column) -> Column:
    return t.rlike("^(?:19|20)[0-9]{2}$|^2100$|^[0-9]+(?:년|월|일|분기|q)$|^[1-4]q$|^q[1-4]$")


def is_noise(t: Column, cfg: Config) -> Column:
    return t.isin(*cfg.stopwords, *cfg.noise_words) | ends_in(t, cfg.media_suffixes) | t.rlike("^[0-9]+$|^.$")


def is_org_like(t: Column, cfg: Config) -> Column:
    return ends_in(t, cfg.org_suffixes)


def labelled(tokens: Column, vocabulary: tuple[tuple[str, tuple[str, ...]], ...], least: int = 1) -> Column:
    """Labels that have `least` or more of their words among the tokens, in the vocabulary's order."""
    flags = [F.when(F.size(F.array_intersect(tokens, lit_array(ws))) >= least, F.lit(label)) for label, ws in vocabulary]
    return F.array_compact(F.array(*flags)) if flags else lit_array(())


def dedupe_key(title: Column, summary: Column, cfg: Config) -> Column:
    return key_of(raw_tokens(title), raw_tokens(summary), cfg)


def key_of(title: Column, summary: Column, cfg: Config) -> Column:
    """Of the raw tokens of title and summary: 4 to 8 telling tokens of title and summary, sorted and joined by hyphens.

    The best 8 by (from the title 3, organisation 2, digits 2, long 1), then place, then length;
    fewer than 4 are refilled from all tokens.
    """
    blocked = lit_array([w for _, ws in cfg.event_labels for w in ws] + list(cfg.actions))

    def choose(x: Column) -> Column:
        # the title's tokens are distinct and come first, so a place tells whether a token is one of them
        every = F.transform(F.array_distinct(F.concat(x["title"], x["summary"])), lambda t, i: F.struct(t.alias("t"), (i < F.size(x["title"])).alias("titled")))
        loose = F.filter(every, lambda e: ~is_date_like(e["t"]) & ~F.array_contains(blocked, e["t"]))
        return bound(loose, lambda es: bound(F.filter(es, lambda e: ~is_noise(e["t"], cfg)), lambda strict: F.when(F.size(strict) >= 4, strict).otherwise(es)))

    def best(x: Column) -> Column:
        def ranked(e: Column, i: Column) -> Column:
            t = e["t"]
            worth = e["titled"].cast("int") * 3 + is_org_like(t, cfg).cast("int") * 2 + t.rlike("[0-9]").cast("int") * 2 + (F.length(t) >= 6).cast("int")
            return F.struct((-worth).alias("w"), i.alias("i"), (-F.length(t)).alias("l"), t.alias("t"))

        return F.transform(F.slice(F.sort_array(F.transform(choose(x), ranked)), 1, 8), lambda r: r["t"])

    tokens = F.struct(normal_of(title, cfg).alias("title"), normal_of(summary, cfg).alias("summary"))
    raw = F.array_distinct(F.concat(title, summary))
    filled = bound(bound(tokens, best), lambda b: F.when(F.size(b) >= 4, b).otherwise(bound(raw, lambda r: F.slice(F.concat(b, F.array_except(r, b)), 1, 4))))
    return F.coalesce(F.nullif(F.array_join(F.array_sort(filled), "-"), F.lit("")), F.lit("news"))


def key_tokens(key: Column) -> Column:
    return F.filter(F.split(F.coalesce(key, F.lit("")), "-"), lambda x: x != "")


def key_ngrams(key: Column, n: int = 2) -> Column:
    """Distinct character n-grams of the key without hyphens and blanks."""
    flat = F.regexp_replace(F.coalesce(key, F.lit("")), "[- ]", "")

    def grams(c: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1)))
        return F.when(F.length(c) >= n, F.array_distinct(F.transform(places, lambda i: F.substring(c, i, F.lit(n))))).otherwise(lit_array(()))

    return bound(flat, grams)


def relation(tokens: Column, cfg: Config) -> Column:
    """The relation with the most words among the tokens; ties by longer, then smaller label."""
    found = [F.struct((-F.size(F.array_intersect(tokens, lit_array(ws)))).alias("n"), F.lit(-len(label)).alias("l"), F.lit(label).alias("label")) for label, ws in cfg.relations]
    best = F.get(F.array_sort(F.filter(F.array(*found), lambda x: x["n"] < 0)), F.lit(0)) if found else None
    return best["label"] if best is not None else F.lit(None).cast("string")


def entities(tokens: Column, cfg: Config) -> Column:
    """Tokens that name something: no noise, no date, of valid length, and no word of a vocabulary."""
    words = {w for v in (cfg.event_labels, cfg.domain_labels, cfg.relations) for _, ws in v for w in ws} | set(cfg.actions)
    return F.filter(tokens, lambda t: ~is_noise(t, cfg) & ~is_date_like(t) & valid_length(t) & ~F.array_contains(lit_array(sorted(words)), t))


def cluster_key(key: Column, hint: Column | None, cfg: Config) -> Column:
    return cluster_of(key, None if hint is None else raw_tokens(hint), cfg)


def cluster_of(key: Column, hint: Column | None, cfg: Config) -> Column:
    """Of a key and the raw tokens of a hint: up to 4 parts joined by slashes: relation and event, one domain, one entity, then what is left of each."""
    def parts(x: Column) -> Column:
        tokens = x["own"] if hint is None else F.when(F.size(x["hint"]) > 0, x["hint"]).otherwise(x["own"])
        return F.struct(labelled(tokens, cfg.event_labels).alias("events"), labelled(tokens, cfg.domain_labels, 2).alias("domains"), entities(x["own"], cfg).alias("names"), relation(tokens, cfg).alias("relation"))

    def joined(x: Column) -> Column:
        event = F.get(x["events"], F.lit(0))
        head = F.array_compact(F.array(F.coalesce(F.concat(x["relation"], F.lit("_"), event), event, x["relation"])))
        first = F.concat(head, F.slice(x["domains"], 1, 1), F.slice(x["names"], 1, 1))
        full = (F.size(x["names"]) > 0) & ((F.size(x["events"]) > 0) | (F.size(x["domains"]) > 0))
        rest = F.concat(F.slice(x["events"], 2, 9), F.slice(x["domains"], 2, 9), F.when(full, lit_array(())).otherwise(x["names"]))
        return F.array_join(F.slice(F.array_distinct(F.concat(first, rest)), 1, 4), "/")

    own = F.struct(key_tokens(key).alias("own"), F.array_distinct(hint if hint is not None else raw_tokens(key)).alias("hint"))
    return bound(bound(own, parts), joined)


def judged_key(raw: Column, cfg: Config) -> Column:
    """A judged key, normalised: no repeats, stopwords, noise, dates or labels; at most 8; refilled to 4 with noise allowed."""
    parts = F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), f"[^a-z0-9{HANGUL}-]", ""), "-"), lambda x: x != ""))
    labels = lit_array([label for label, _ in cfg.event_labels])

    def choose(loose: Column) -> Column:
        strict = F.slice(F.filter(loose, lambda t: ~is_noise(t, cfg) & valid_length(t)), 1, 8)
        return bound(strict, lambda s: F.when(F.size(s) >= 4, s).otherwise(F.slice(F.concat(s, F.array_except(loose, s)), 1, 4)))

    out = bound(F.filter(parts, lambda t: ~is_date_like(t) & ~F.array_contains(labels, t)), choose)
    return F.coalesce(F.nullif(F.array_join(out, "-"), F.lit("")), raw)
