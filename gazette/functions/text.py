"""Text shaping, one column in and one column out (Column -> Column)."""

import html
import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gazette.config import Config


def bound(c: Column, f) -> Column:
    """f(c), with c computed once: inside, it is a variable and not the expression again."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def any_of(keywords: tuple[str, ...]) -> str:
    """One case-insensitive alternation of quoted keywords; matches nothing for an empty list."""
    return "(?i)(?:" + "|".join(re.escape(k) for k in keywords) + ")" if keywords else r"(?!)"


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for a row, whatever reads them or filters by them later: nothing is pushed or inlined through a generator."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


@dataclass(frozen=True)
class Lowered:
    """A text that lowered() has made, which many vocabularies can be looked up in."""

    column: Column


@dataclass(frozen=True)
class Said:
    """Which keywords of a vocabulary a text has, looked up once for all that ask: flags() of its words, in order."""

    column: Column
    words: tuple[str, ...]

    def has(self, keyword: str) -> Column:
        return F.get(self.column, F.lit(self.words.index(keyword)))


def flags(low: Column, words: tuple[str, ...]) -> Column:
    return F.array(*(F.contains(low, F.lit(w)) for w in words)) if words else F.array().cast("array<boolean>")


def lowered(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit("")))


def mentions(c: Column | Lowered | Said, keywords: tuple[str, ...]) -> Column:
    """True if any keyword occurs in the text, whatever its case. Null text: false. A text is lowered once, and not at all if that has been done; where its keywords are known, it isn't read."""
    if isinstance(c, Said):
        return reduce(lambda a, b: a | b, (c.has(k.lower()) for k in keywords), F.lit(False))
    said = lambda low: reduce(lambda a, b: a | b, (F.contains(low, F.lit(k.lower())) for k in keywords), F.lit(False))
    if isinstance(c, Lowered):
        return said(c.column)
    return bound(lowered(c), said) if len(keywords) > 1 else said(lowered(c))


def falsy(c: Column) -> Column:
    """An empty string as null, so that coalesce() reads like `a or b`."""
    return F.nullif(c, F.lit(""))


def _unescape(c: pd.Series) -> pd.Series:
    has = c.str.contains("&", regex=False, na=False)
    return c.where(~has, c[has].map(html.unescape))


def unescape(c: Column) -> Column:
    """HTML entities decoded; there is no built-in for it. Rows without '&' are passed through."""
    return pandas_udf(_unescape, "string")(c)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_text(c: Column, entities: bool = True) -> Column:
    """Entities decoded, no-break spaces to spaces, tags off, white space collapsed. Entities come first, so escaped tags go too."""
    c = unescape(c) if entities else c
    return collapse(F.regexp_replace(F.replace(c, F.lit(" "), F.lit(" ")), r"<[^>]+>", ""))


def contains_binary(c: Column) -> Column:
    """More than 1 % replacement characters, or signatures of image chunks."""
    share = (F.length(c) - F.length(F.replace(c, F.lit("�"), F.lit("")))) / F.greatest(F.length(c), F.lit(1))
    return (share > 0.01) | F.upper(c).rlike("IHDR|IDAT|IEND")


def sanitize(c: Column) -> Column:
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " ")
    return F.when(contains_binary(c), "").otherwise(F.trim(c))


def strip_source(summary: Column, source: Column) -> Column:
    """The outlet's name, with a separator or glued on, off the end of the summary. The tail is compared by its length: a name isn't a pattern.

    Both arguments enter the variable: Spark allows no Python function, such as clean_text()'s, inside a lambda.
    """
    bare = lambda c: F.regexp_replace(c, r"[\s.]*$", "")
    cut = lambda x: F.regexp_replace(F.substring(x["t"], F.lit(1), F.length(x["t"]) - F.length(x["name"])), r"[\s\-|·:]*$", "")
    ends = lambda x: (x["name"] != "") & F.endswith(F.lower(x["t"]), F.lower(x["name"]))
    told = bound(F.struct(summary.alias("s"), F.coalesce(source, F.lit("")).alias("o")), lambda x: F.struct(x["s"].alias("s"), bare(x["s"]).alias("t"), bare(x["o"]).alias("name")))
    return bound(told, lambda x: F.when(ends(x), cut(x)).otherwise(x["s"]))


def trim_title(title: Column, source: Column, cfg: Config) -> Column:
    """Leading label tags, trailing bracket tags, the row's own outlet, by-lines, and known outlets after a separator, off the title."""
    t = F.regexp_replace(collapse(title), r"^(?:[\[(【<][^\])】>]{1,20}[\])】>]\s*)+", "")
    t = F.regexp_replace(t, r"(?:\s*[\[(【<][^\])】>]{1,20}[\])】>])+$", "")
    t = strip_source(t, source)
    t = F.regexp_replace(t, r"\s*\S+@\S+\.\S+$", "")
    t = F.regexp_replace(t, r"\s*[-|·]\s*(?:" + "|".join(map(re.escape, cfg.outlets)) + r")\s*$", "")
    return F.trim(t)


def normalize_source(c: Column, cfg: Config) -> Column:
    """First word of the name's letters and digits, less one media suffix."""
    word = F.get(F.split(F.trim(F.regexp_replace(c, r"[^0-9A-Za-z가-힣\s]", " ")), r"\s+"), F.lit(0))
    cut = F.regexp_replace(word, "(?i)(?:" + "|".join(cfg.media_suffixes) + ")$", "")
    return F.when(F.length(cut) > 0, cut).otherwise(word)


def parse_timestamp(c: Column) -> Column:
    """ISO-8601, else RFC-2822 (its weekday off first); failure is null. Times without a zone are taken at +09:00, whatever the session's zone."""
    iso = F.trim(c)
    naive = iso.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9:.]+)?$")
    iso = F.when(naive & ~F.contains(iso, F.lit(":")), F.concat(F.substring(iso, 1, 10), F.lit("T00:00:00+09:00"))).when(naive, F.concat(iso, F.lit("+09:00"))).otherwise(iso)
    rfc = F.regexp_replace(c, r"^[A-Za-z]{3},\s*", "")
    rfc = F.when(rfc.rlike(r"[0-9]{2}:[0-9]{2}:[0-9]{2}\s*$"), F.concat(F.trim(rfc), F.lit(" +0900"))).otherwise(rfc)
    zoned = [F.try_to_timestamp(rfc, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z")]
    return F.coalesce(F.try_to_timestamp(iso), *zoned)


def age_hours(published: Column, updated: Column, cfg: Config) -> Column:
    at = F.coalesce(published.cast("timestamp"), updated)
    return (F.unix_micros(F.lit(cfg.run_ts).cast("timestamp")) - F.unix_micros(at)) / F.lit(3.6e9)


def read_time(c: Column) -> Column:
    """Seconds at 500 characters a minute, rounded half-even to tens, 10 to 40."""
    return F.greatest(F.lit(10), F.least(F.lit(40), (F.bround(F.length(F.trim(F.coalesce(c, F.lit("")))) / F.lit(500.0) * 60 / 10) * 10).cast("int")))


def strip_boilerplate(c: Column, cfg: Config) -> Column:
    """Each line is cut at its first legal or contact mark; a line with less than 12 characters before it goes."""
    mark = any_of(cfg.boilerplate)
    cut = lambda x: F.regexp_replace(x, mark + r".*$", "")
    lines = F.filter(F.split(c, r"[\r\n]+"), lambda x: ~x.rlike(mark) | (F.length(F.trim(cut(x))) >= 12))
    return F.concat_ws("\n", F.transform(lines, lambda x: F.regexp_replace(F.trim(cut(x)), r"[\s|\-·,:;]+$", "")))


def sentences(c: Column) -> Column:
    """Split after sentence punctuation that white space follows."""
    return F.filter(F.split(c, r"(?<=[.!?。])\s+"), lambda x: F.trim(x) != "")


def summary_lines(c: Column, cfg: Config) -> Column:
    """Up to 3 different cleaned lines, in order; sentences of the whole where no line is left."""
    lines = F.filter(F.transform(F.split(strip_boilerplate(c, cfg), "\n"), collapse), lambda x: x != "")
    first = F.slice(F.array_distinct(lines), 1, 3)
    return bound(first, lambda x: F.when(F.size(x) > 0, x).otherwise(F.slice(sentences(collapse(c)), 1, 3)))


def input_hash(title: Column, summary: Column) -> Column:
    return F.substring(F.sha1(collapse(F.concat_ws(" ", title, summary)).cast("binary")), 1, 12)


def topic_category(topic: Column, cfg: Config) -> Column:
    """The first rule whose fragment occurs in the topic."""
    low = F.lower(F.coalesce(topic, F.lit("")))
    out = F.lit(cfg.default_category)
    for fragment, category in reversed(cfg.categories):
        out = F.when(F.contains(low, F.lit(fragment)), category).otherwise(out)
    return out


def item_category(judged: Column, topic: Column, cfg: Config) -> Column:
    """The judged category if it is allowed; an international judgment on a domestic topic is overridden."""
    allowed = sorted({c for _, c in cfg.categories} | {cfg.default_category})
    by_topic = topic_category(topic, cfg)
    good = judged.isin(*allowed) & ~((judged == cfg.default_category) & (by_topic != cfg.default_category))
    return F.when(F.coalesce(good, F.lit(False)), judged).otherwise(by_topic)


def summary_source(title: Column, summary: Column) -> Column:
    return F.when(F.lower(summary) != F.lower(title), summary).otherwise("")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 where both are empty."""

    def of(x: Column) -> Column:
        union = x["n"] - x["both"]
        return F.when(union > 0, x["both"] / union).otherwise(F.lit(0.0))

    sized = bound(F.struct(a.alias("a"), b.alias("b")), lambda x: F.struct(F.size(F.array_intersect(x["a"], x["b"])).alias("both"), (F.size(x["a"]) + F.size(x["b"])).alias("n")))
    return bound(sized, of)
