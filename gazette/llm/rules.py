"""Quality rules (operator 9), with DataFrame functions only: cross-document line frequency over simple text rules.

Base rules look at one text. The method hashes normalised lines (lower case, white
space collapsed), counts the distinct documents of a host (`source`) that hold each,
takes lines above the limit out, and rejects documents that too little is left of. A line is above the
limit when more than 20 distinct doc_ids and more than 0.1 % of the host's rows hold it: the
count decides on hosts of up to 20,000 rows, the share on larger ones.

Defined cases: a null or empty text has no words and fails the base rules; a null host is a
host of its own; rows that repeat a doc_id count once towards a line's limit and share the words
that frequent lines take (cleaned() judges each alone); rows without a doc_id don't count towards
it; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the word rule: a blank and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
_GAP = r"[\x20\x09-\x0D]+"


def split_words(text: Column) -> Column:
    inner = F.trim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _GAP))


def _doubled(h: Column, step: int) -> Column:
    """Hashes of runs twice as long: pairs, fours, then eights of words."""
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))


def measured(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, source, text and the base figures. Row-local; nothing is shuffled."""
    df = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    df = df.withColumns({"words": split_words(F.col("text")), "lines": F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)) != "")})
    df = df.withColumns({"n": F.size("words"), "h": F.transform("words", lambda x: F.xxhash64(x))})
    df = df.withColumn("h", _doubled(F.col("h"), 1)).withColumn("h", _doubled(F.col("h"), 2)).withColumn("h", F.when(F.col("n") >= 8, F.slice(_doubled(F.col("h"), 4), F.lit(1), F.greatest(F.col("n") - 7, F.lit(0)))))
    df = df.withColumn("repeats", F.size(F.array_distinct("h")) < F.size("h"))
    placed = F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("placed", F.when(F.col("repeats"), placed))
    twice = F.filter("placed", lambda x, i: F.coalesce(F.get("placed", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False)))
    df = df.withColumn("at", F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(F.transform("at", lambda p, i: F.least(F.lit(8), F.coalesce(F.get("at", i + 1) - p, F.lit(8)))), F.lit(0), lambda a, x: a + x)
    return df.select(
        "doc_id", "source", "lines",
        F.xxhash64("text").alias("text_hash"),
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def normal(line: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(line, F.lit(BLANKS))), _GAP, " ")


def _hashes() -> Column:
    return F.transform("lines", lambda x: F.xxhash64(normal(x)))


def _host() -> Column:
    return F.coalesce("source", F.lit("\0"))


def _frequent(base: DataFrame, docs: DataFrame, limit_docs: int, limit_share: float) -> tuple[DataFrame, DataFrame]:
    """(source, line) of the lines above the limit, and (source, line, docs, doc_id, w): the words that lines which may be take in each document."""
    # a line counts once for a document; all its words there go
    seen = base.select(_host().alias("source"), F.explode(F.array_distinct(_hashes())).alias("line")).groupBy("source", "line").agg(F.count("*").alias("n")).where(F.col("n") > limit_docs)
    hosts = docs.select(F.coalesce(docs["source"].cast("string"), F.lit("\0")).alias("source")).groupBy("source").agg(F.count("*").alias("docs"))
    enough = F.col("n") > F.col("docs") * limit_share
    many = seen.join(hosts, "source").where(enough).select("source", "line", "docs")  # by rows, never fewer than documents
    lined = F.transform("lines", lambda x: F.struct(F.xxhash64(normal(x)).alias("line"), F.size(F.split(F.trim(x, F.lit(BLANKS)), _GAP)).alias("w")))
    own = base.select("doc_id", _host().alias("source"), F.explode(lined).alias("l")).select("doc_id", "source", "l.line", "l.w")
    held = own.join(many, ["source", "line"]).groupBy("source", "line", "docs", "doc_id").agg(F.sum("w").alias("w"))
    frequent = held.where("doc_id IS NOT NULL").groupBy("source", "line", "docs").agg(F.count("*").alias("n")).where((F.col("n") > limit_docs) & enough).select("source", "line")
    return frequent, held


def judged(docs: DataFrame, least_words: int = 20, repeat_percent: int = 30, limit_docs: int = 20, limit_share: float = 0.001, least_left: float = 0.5) -> DataFrame:
    """Figures, base_failed, the words that frequent lines take, and kept."""
    base = measured(docs)
    frequent, held = _frequent(base, docs, limit_docs, limit_share)
    taken = held.join(frequent, ["source", "line"], "left_semi").groupBy("doc_id").agg(F.sum("w").alias("n_line_words"))
    out = base.drop("lines", "source").join(taken, "doc_id", "left").withColumn("n_line_words", F.least("n_words", F.coalesce("n_line_words", F.lit(0))).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")))
    left = F.col("n_words") - F.col("n_line_words")
    return out.withColumn("kept", ~F.col("base_failed") & (left >= least_words) & (left >= F.col("n_words") * least_left))


def cleaned(docs: DataFrame, limit_docs: int = 20, limit_share: float = 0.001, **limits) -> DataFrame:
    """The rows of docs that judged() keeps, with the lines above the limit taken out of text; other columns stay.

    Rows are told apart by host and text, so a row without a doc_id, or one of several with the same, has its own lines taken out.
    """
    kept = judged(docs, limit_docs=limit_docs, limit_share=limit_share, **limits).groupBy(F.col("doc_id").alias("_kept"), F.col("text_hash").alias("_of")).agg(F.max("kept").alias("_good")).where("_good")  # a filter right on the figures would compute each of them again and again
    frequent, _ = _frequent(measured(docs), docs, limit_docs, limit_share)
    text, host = F.coalesce(docs["text"].cast("string"), F.lit("")), F.coalesce(docs["source"].cast("string"), F.lit("\0"))
    rows = docs.select(*[docs[c] for c in docs.columns], text.alias("_text"), host.alias("_host"), F.xxhash64(text).alias("_hash"), docs["doc_id"].cast("long").alias("_id"))
    own = rows.select("_hash", F.col("_host").alias("source"), F.explode(F.array_distinct(F.transform(F.split("_text", "\n", -1), lambda x: F.xxhash64(normal(x))))).alias("line"))
    gone = own.join(frequent, ["source", "line"], "left_semi").groupBy("_hash", F.col("source").alias("_host")).agg(F.collect_set("line").alias("_gone"))
    stays = lambda x: (F.trim(x, F.lit(BLANKS)) == "") | ~F.array_contains("_gone", F.xxhash64(normal(x)))
    after = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(F.split("_text", "\n", -1), stays), "\n"))
    good = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_hash") == F.col("_of")), "left_semi")
    return good.join(gone, ["_hash", "_host"], "left").select(*(after.alias(c) if c == "text" else F.col(c) for c in docs.columns))
