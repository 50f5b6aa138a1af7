"""Secret scans (operator 5), with DataFrame functions only.

Three fixed patterns give the base spans. The method adds spans of its own: candidate
strings are scanned by a sliding window, per character class, whose letter counts and
entropy sum are updated as one character enters and one leaves; a candidate whose most
mixed window reaches the class's limit is a secret. Parts that fit the allow-list are taken out
first and what is left is judged, so a secret glued to a placeholder is still found, whole.

Offsets count code points, ends are exclusive. A pattern's matches and the pieces between
them give the offsets: both are arrays, and their lengths add up.

Defined cases: a null or empty text has no spans and the hash of the empty string; ties in
start are ordered by kind; rows are handled alone, so repeated rows give repeated results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: A candidate: a run of 20 or more characters of encoded data.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character classes: (whole candidate, whether case is folded, least entropy in bits of its most mixed window).
CLASSES = ((r"^[0-9a-fA-F]+$", True, 3.0), (r"^[A-Za-z0-9+/_=-]+$", False, 3.7))
#: Parts that look random but are no secrets, taken out of a candidate: placeholders, counting and alphabet runs, one sign repeated, a digest that names its method.
_DIGESTS = "|".join(f"{bits}-(?:[0-9a-fA-F]{{{h}}}(?![A-Za-z0-9+/])|[A-Za-z0-9+/]{{{b}}})" for bits, h, b in ((1, 40, 27), (256, 64, 43), (384, 96, 64), (512, 128, 86)))
ALLOWED = rf"^sha(?:{_DIGESTS})={{0,2}}|(?i:example|sample|placeholder|dummy|x{{5,}})|0123456789|abcdefgh|(.)\1{{9,}}"
#: What is left is no secret where it has no digit or no letter.
PLAIN = r"^[^0-9]*$|^[^A-Za-z]*$"


_BLOCK = 128


def running(values: Column, zero: Column, join) -> Column:
    """array of join(values[0], ..., values[i]) for each i. An array grows by copying, so it is done in blocks: cost n * _BLOCK + (n / _BLOCK)^2, not n^2."""
    none = F.slice(F.array(zero), 1, 0)
    many = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _BLOCK).cast("int")), lambda k: F.slice(x, k * _BLOCK + 1, F.lit(_BLOCK)))

    def alone(block: Column, first: Column) -> Column:
        step = lambda acc, v: F.struct(join(acc["at"], v).alias("at"), F.array_append(acc["out"], join(acc["at"], v)).alias("out"))
        return F.aggregate(block, F.struct(first.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def whole(x: Column) -> Column:
        blocks = F.transform(many(x), lambda block: F.struct(block.alias("v"), F.aggregate(block, zero, join).alias("all")))
        return _let(blocks, lambda bs: _let(alone(F.transform(bs, lambda b: b["all"]), zero), lambda sums: F.flatten(F.transform(bs, lambda b, k: alone(b["v"], F.when(k > 0, F.get(sums, k - 1)).otherwise(zero))))))

    return _let(values, lambda x: F.when(F.size(x) == 0, none).otherwise(whole(x)))


def _let(value: Column, use) -> Column:
    """use(value) with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, t>> of the leftmost matches that don't overlap; null where there is none."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.struct(found.alias("m"), between.alias("p"))

    def place(x: Column) -> Column:
        lengths = F.transform(x["m"], lambda m, i: F.length(F.get(x["p"], i)) + F.length(m))
        return _let(running(lengths, F.lit(0), lambda a, v: a + v), lambda ends: F.transform(x["m"], lambda m, i: F.struct((F.get(ends, i) - F.length(m)).alias("s"), F.get(ends, i).alias("e"), m.alias("t"))))

    return F.when(text.rlike(pattern), _let(both, place))


#: c * log2(c) for the numbers that a window can hold of one character.
_WEIGHTS = [c * math.log2(c) if c else 0.0 for c in range(WINDOW + 1)]


def best_entropy(text: Column) -> Column:
    """The largest entropy of a window: the sum of c * log2(c) changes by the counts of the character that enters and of the one that leaves.

    The candidate is split once. A character enters with the number of its equals among the
    WINDOW - 1 before it, and leaves with that among those after it, so a step costs the same
    at any place of a candidate of any length.
    """
    weight = lambda c: F.get(F.array(*map(F.lit, _WEIGHTS)), c)
    near = lambda c, x, start, n: F.size(F.filter(F.slice(c, start, n), lambda y: y == x))

    def scan(c: Column) -> Column:
        before = F.transform(c, lambda x, i: near(c, x, F.greatest(i - WINDOW + 2, F.lit(1)), F.least(i, F.lit(WINDOW - 1))))
        after = F.transform(c, lambda x, i: near(c, x, i + 2, F.lit(WINDOW - 1)))
        return _let(F.struct(before.alias("b"), after.alias("a")), lambda n: F.aggregate(F.sequence(F.lit(0), F.size(c) - 1), F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")), lambda acc, i: step(n, acc, i), lambda acc: acc["best"]))

    def step(n: Column, acc: Column, i: Column) -> Column:
        enters, leaves = F.get(n["b"], i), F.get(n["a"], i - WINDOW)
        total = acc["sum"] + weight(enters + 1) - weight(enters) + F.when(i >= WINDOW, weight(leaves) - weight(leaves + 1)).otherwise(F.lit(0.0))
        best = F.when(i >= WINDOW - 1, F.greatest(acc["best"], F.lit(math.log2(WINDOW)) - total / WINDOW)).otherwise(acc["best"])
        return F.struct(total.alias("sum"), best.alias("best"))

    return _let(F.split(text, ""), scan)


def is_secret(text: Column) -> Column:
    """Without its allowed parts, the candidate reaches the entropy limit of the first class that it then belongs to."""

    def judged(left: Column) -> Column:
        verdict = F.lit(False)
        for whole, fold, least in reversed(CLASSES):
            verdict = F.when(left.rlike(whole), best_entropy(F.lower(left) if fold else left) >= least).otherwise(verdict)
        return F.when((F.length(left) < WINDOW) | left.rlike(PLAIN), F.lit(False)).otherwise(verdict)

    return F.exists(F.array(F.regexp_replace(text, ALLOWED, "")), judged)  # computed once


def found(docs: DataFrame, *keep: str) -> DataFrame:
    """text, the kept columns, and array columns assign, access, hex and entropy of spans (s, e, t)."""
    none = F.array().cast("array<struct<s:int,e:int,t:string>>")
    df = docs
    df = df.select(*keep, "text", spans(df["text"], ASSIGN).alias("assign"), spans(df["text"], ACCESS).alias("access"), spans(df["text"], HEX).alias("hex"), spans(df["text"], CANDIDATE).alias("candidates"))
    df = df.withColumn("assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x["t"], ASSIGN, 2)) >= 6))
    df = df.select(*keep, "text", *(F.coalesce(c, none).alias(c) for c in ("assign", "access", "hex", "candidates")))
    # a candidate inside a base span isn't judged: of the base spans that start at or before it, the furthest end decides
    ranked = F.array_sort(F.concat(F.transform(F.concat("assign", "access", "hex"), lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("own"), x["e"].alias("e"), F.lit("").alias("t"))), F.transform("candidates", lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("own"), x["e"].alias("e"), x["t"].alias("t")))))
    reach = lambda r: running(F.transform(r, lambda x: F.when(x["own"] == 0, x["e"]).otherwise(F.lit(0))), F.lit(0), lambda a, v: F.greatest(a, v))
    outside = _let(ranked, lambda r: _let(reach(r), lambda far: F.filter(r, lambda x, i: (x["own"] == 1) & (F.get(far, i) < x["e"]) & is_secret(x["t"]))))
    outside = F.transform(outside, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["t"].alias("t")))
    return df.select(*keep, "text", "assign", "access", "hex", F.when(F.size("candidates") > 0, outside).otherwise(none).alias("entropy"))


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    ranked = lambda i: lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e"))
    every = F.concat(*(F.transform(k, ranked(i)) for i, k in enumerate(kinds)))
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(F.array_sort(every), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their hash, and all spans as text."""
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found(texts(docs), "doc_id").select("doc_id", *counts, F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"), listed(KINDS).alias("spans"))


_PAGE = 4096


def _cut(pages: Column, start: Column, end: Column) -> Column:
    """The code points start to end - 1 of a text given as pages: only the pages that they touch are read."""
    first = F.floor(start / _PAGE).cast("int")
    touched = F.slice(pages, first + 1, F.greatest(F.ceil(end / _PAGE).cast("int") - first, F.lit(0)))
    inside = lambda page, k: F.substring(page, F.greatest(start - (first + k) * _PAGE, F.lit(0)) + 1, F.least(end - F.greatest(start, (first + k) * _PAGE), F.lit(_PAGE)))
    return F.array_join(F.transform(touched, inside), "")


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with each secret in text replaced by the mark (spans that overlap are one); other columns stay, n_chars follows the text."""
    every = F.array_sort(F.concat(*(F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS)))

    def cleaned(all_: Column) -> Column:
        far = running(F.transform(all_["spans"], lambda x: x["e"]), F.lit(0), lambda a, v: F.greatest(a, v))
        opens = lambda x, end: F.struct((x["s"] >= end).alias("new"), end.alias("s"), x["s"].alias("e"))
        gaps = lambda f: F.filter(F.transform(all_["spans"], lambda x, i: opens(x, F.coalesce(F.get(f, i - 1), F.lit(0)))), lambda g: g["new"])
        parts = lambda f: F.concat(F.transform(gaps(f), lambda g: F.concat(_cut(all_["pages"], g["s"], g["e"]), F.lit(mark))), F.array(_cut(all_["pages"], F.element_at(f, -1), F.length("text"))))
        return _let(far, lambda f: F.array_join(parts(f), ""))

    pages = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))
    clean = _let(F.struct(every.alias("spans"), pages.alias("pages")), cleaned)
    rest = [c for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*rest).alias("rest"), F.col("text").cast("string").alias("text")) if rest else docs
    out = found(whole, "rest").withColumn("text", F.when(F.size(every) > 0, clean).otherwise(F.col("text")))
    kinds = dict(docs.dtypes)
    return out.select(*(F.col("text") if c == "text" else F.when(F.size(every) > 0, F.length("text").cast(kinds[c])).otherwise(F.col(f"rest.`{c}`")).alias(c) if c == "n_chars" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))
