"""Ranked duplicate passes. A row merged earlier can't absorb later ones, so chains aren't components."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.config import Config
from gazette.functions.text import bound, collapse, falsy, jaccard
from gazette.functions.tokens import HANGUL, is_date_like, is_noise, is_org_like, key_ngrams, key_tokens, lit_array, normal_tokens
from gazette.operators.joins import SIGNATURE, equal_sets, may_be_similar, prefix_meet, prefixes, set_similarity_join, signature


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the shared folder that spark.checkpoint.dir names (a folder of our own only if unset)."""
    spark: SparkSession = df.sparkSession
    path = f"{folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; a folder of our own only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def resolve(edges: DataFrame) -> DataFrame:
    """(lo, matched_to): rows merged into the earliest kept row that they match.

    edges(lo, hi, rank): lo matches hi, which is earlier; rank orders the his. In each round a
    row is merged if a neighbour above is kept, and kept if all above are merged; the first
    undecided row is always decided, so the rounds end.
    """
    edges = stored(edges.select("lo", "hi", "rank"))
    kept = stored(edges.select(F.col("hi").alias("id")).distinct().join(edges.select(F.col("lo").alias("id")).distinct(), "id", "left_anti"))
    merged: DataFrame | None = None
    open_ = edges
    while True:
        hit = open_.join(kept.withColumnRenamed("id", "hi"), "hi", "left_semi").groupBy("lo").agg(F.min_by("hi", F.struct("rank", "hi")).alias("matched_to"))
        merged = stored(hit if merged is None else merged.unionByName(hit.join(merged.select("lo"), "lo", "left_anti")))
        left = open_.join(merged.select("lo"), "lo", "left_anti")  # undecided rows
        waiting = left.join(merged.select(F.col("lo").alias("hi")), "hi", "left_anti")  # edges to rows that may still be kept
        free = left.select("lo").distinct().join(waiting.select("lo").distinct(), "lo", "left_anti")
        kept = stored(kept.unionByName(free.select(F.col("lo").alias("id"))))
        open_ = stored(waiting)
        if not open_.limit(1).count():
            break
    # the earliest kept match, over all edges
    return edges.join(merged.select("lo"), "lo", "left_semi").join(kept.withColumnRenamed("id", "hi"), "hi", "left_semi").groupBy("lo").agg(F.min_by("hi", F.struct("rank", "hi")).alias("matched_to"))


def _edges(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    return pairs.join(rows.select(F.col("id").alias("hi"), "rank"), "hi")


def merged_into(rows: DataFrame, found: DataFrame, reason: str) -> DataFrame:
    """rows with status, merge_reason and matched_to after a pass."""
    out = rows.join(found.select(F.col("lo").alias("id"), "matched_to"), "id", "left")
    return out.withColumn("status", F.when(F.col("matched_to").isNotNull(), "merged").otherwise("kept")).withColumn("merge_reason", F.when(F.col("matched_to").isNotNull(), reason))


def _by_class(sets: DataFrame, threshold: float) -> DataFrame:
    """(lo, matched_to) for sets(id, rank, tokens): the resolver sees the first row of each class of equal sets; what holds for it holds for the others, which match it."""
    found = stored(resolve(_edges(set_similarity_join(sets, threshold).select("lo", "hi"), sets)))
    members = equal_sets(sets)
    out = members.join(found.select(F.col("lo").alias("first"), "matched_to"), "first", "left")
    return out.select(F.col("id").alias("lo"), F.coalesce("matched_to", "first").alias("matched_to")).where("lo <> matched_to")


def title_duplicates(rows: DataFrame, cfg: Config) -> DataFrame:
    """rows(id, rank, title): near titles merge into the first kept one; then exact titles."""
    sets = stored(rows.select("id", "rank", normal_tokens(F.col("title"), cfg).alias("tokens")))
    found = _by_class(sets, cfg.title_threshold)
    left = rows.join(found.select(F.col("lo").alias("id")), "id", "left_anti")
    named = left.where("title <> ''")
    firsts = named.groupBy("title").agg(F.min(F.struct("rank", "id")).alias("f")).select("title", F.col("f.id").alias("matched_to"))
    exact = named.join(firsts, "title").select(F.col("id").alias("lo"), "matched_to").where("lo <> matched_to")
    return merged_into(rows, found.unionByName(exact), "title_duplicate")


def cluster_duplicates(rows: DataFrame, cfg: Config) -> DataFrame:
    """rows(id, rank, title, dedupe_key, cluster_key): compared with the first holder of the cluster key only.

    Keys of under two parts can't merge and go first; the first holder comes from a
    pre-aggregated minimum, and words and bigrams are made only for rows that have another before them.
    """
    some = rows.where(F.size(F.filter(F.split("cluster_key", "[/_-]"), lambda x: x != "")) >= 2).select("id", "rank", "title", "dedupe_key", "cluster_key")
    firsts = some.groupBy("cluster_key").agg(F.min(F.struct("rank", "id")).alias("f"), F.count("*").alias("n")).where("n > 1").select("cluster_key", F.col("f.id").alias("first"))
    held = stored(some.join(firsts, "cluster_key"))
    heads = held.where("id = first").select("first", F.col("title").alias("title2"), F.col("dedupe_key").alias("key2"))
    both = held.where("id <> first").join(heads, "first")
    tokens = lambda c: normal_tokens(F.col(c), cfg)
    t = jaccard(tokens("title"), tokens("title2"))
    k = jaccard(key_ngrams(F.col("dedupe_key")), key_ngrams(F.col("key2")))
    hit = (t >= max(0.3, cfg.title_threshold)) & (k >= max(0.3, cfg.key_threshold))
    return merged_into(rows, both.where(hit).select(F.col("id").alias("lo"), F.col("first").alias("matched_to")), "cluster_duplicate")


def entity_events(rows: DataFrame, cfg: Config) -> DataFrame:
    """rows(id, rank, entities, events, action): same action and main entity, or a shared event group and enough shared entities.

    Rows with equal entities, events and action are one class: all after its first match the first (a
    class of one weak entity without an action matches nothing, itself neither).
    Classes meet by (action, main entity), by (event, strong entity) and by (event, pair of entities),
    never by one common entity alone.
    """
    near = rows.select("id", "rank", "entities", "events", F.coalesce("action", F.lit("")).alias("action")).where((F.size("events") > 0) & (F.size("entities") > 0))
    strong = lambda t: is_org_like(t, cfg) | t.rlike(f"^[{HANGUL}]{{3,}}$") | t.rlike("^[a-z0-9]{5,}$")
    near = near.where((F.size("entities") >= 2) | (F.col("action") != "") | F.exists("entities", strong)).withColumn("class", F.xxhash64(F.to_json(F.struct("entities", F.array_sort("events").alias("events"), "action"))))
    classes = stored(near.groupBy("class").agg(F.min(F.struct("rank", "id")).alias("first"), F.first("entities").alias("entities"), F.first("events").alias("events"), F.first("action").alias("action")).select("class", "first.rank", "first.id", "entities", "events", "action"))
    names = F.array_sort("entities")
    pairs_of = F.flatten(F.transform(names, lambda x, i: F.transform(F.slice(names, i + 2, F.size(names)), lambda y: F.concat_ws("\0", x, y))))
    told = F.concat(F.filter("entities", strong), pairs_of)
    by_event = F.flatten(F.transform("events", lambda e: F.transform(told, lambda x: F.concat_ws("\1", e, x))))
    by_action = F.when(F.col("action") != "", F.array(F.concat_ws("\2", "action", F.get("entities", F.lit(0))))).otherwise(lit_array(()))
    keys = classes.select("class", "rank", "id", F.explode(F.array_distinct(F.concat(by_event, by_action))).alias("key"))
    a, b = keys.select("key", F.col("id").alias("lo"), F.col("rank").alias("r1")), keys.select("key", F.col("id").alias("hi"), "rank")
    edges = a.join(b, "key").where(F.struct(F.col("r1").alias("r"), F.col("lo").alias("i")) > F.struct(F.col("rank").alias("r"), F.col("hi").alias("i"))).select("lo", "hi", "rank").distinct()
    found = stored(resolve(edges))
    members = near.select("id", "class").join(classes.select("class", F.col("id").alias("head")), "class")
    out = members.join(found.select(F.col("lo").alias("head"), "matched_to"), "head", "left").select(F.col("id").alias("lo"), F.coalesce("matched_to", "head").alias("matched_to")).where("lo <> matched_to")
    return merged_into(rows, out, "entity_event")


def _conflict() -> Column:
    disjoint = lambda a, b: (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)
    return disjoint("numbers", "numbers2") | disjoint("entities", "entities2")


def exact_keys(rows: DataFrame) -> DataFrame:
    """Equal keys of 2+ tokens: each row against the latest one before it that wasn't merged so itself.

    Neighbours in rank order with the same numbers and entities share their first row's fate, so
    only these first rows are folded: a key with very many copies folds over a few. A key whose
    rows keep switching between different numbers is still folded whole.
    """
    w = Window.partitionBy("dedupe_key").orderBy("rank", "id")
    held = rows.where(F.size(key_tokens(F.col("dedupe_key"))) >= 2).select("dedupe_key", "rank", F.col("id").cast("long").alias("id"), F.array_sort("numbers").alias("numbers"), F.array_sort("entities").alias("entities"))
    same = F.lag(F.struct("numbers", "entities")).over(w).eqNullSafe(F.struct("numbers", "entities"))
    held = held.withColumn("start", F.when(~same, F.col("id")))
    runs = stored(held.withColumn("head", F.last("start", ignorenulls=True).over(w)).drop("start"))

    listed = runs.where("id = head").groupBy("dedupe_key").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "numbers", "entities"))).alias("l"))
    blank = F.struct(F.get("l", F.lit(0)).alias("last"), F.array().cast("array<struct<lo:bigint,matched_to:bigint>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        apart = lambda f: (F.size(acc["last"][f]) > 0) & (F.size(x[f]) > 0) & ~F.arrays_overlap(acc["last"][f], x[f])
        hit = (x["id"] != acc["last"]["id"]) & ~apart("numbers") & ~apart("entities")
        return F.struct(F.when(hit, acc["last"]).otherwise(x).alias("last"), F.when(hit, F.array_append(acc["out"], F.struct(x["id"].alias("lo"), acc["last"]["id"].alias("matched_to")))).otherwise(acc["out"]).alias("out"))

    of_heads = listed.select(F.explode(F.aggregate("l", blank, step, lambda a: a["out"])).alias("x")).select(F.col("x.lo").alias("head"), "x.matched_to")
    out = runs.join(of_heads, "head", "left").select(F.col("id").alias("lo"), F.coalesce("matched_to", "head").alias("matched_to"))
    return out.where("lo <> matched_to")


def may_meet(sides: DataFrame, groups: DataFrame) -> DataFrame:
    """(x, y) of rows in classes that meet, sides(c1, c2), whose numbers don't contradict; groups(id, c, numbers).

    Rows meet by a number that they share, and rows without numbers meet all. So a class whose rows
    have many different numbers makes as many pairs as rows share numbers, not one for each two rows.
    """
    side = lambda name, c: groups.select(F.col("id").alias(name), F.col("c").alias(c), F.explode_outer("numbers").alias("number"))
    bare = lambda name, c: groups.where(F.size("numbers") == 0).select(F.col("id").alias(name), F.col("c").alias(c))
    every = lambda name, c: groups.select(F.col("id").alias(name), F.col("c").alias(c))
    shared = sides.join(side("x", "c1").where("number IS NOT NULL"), "c1").join(side("y", "c2"), ["c2", "number"])
    first = sides.join(bare("x", "c1"), "c1").join(every("y", "c2"), "c2")
    second = sides.join(bare("y", "c2"), "c2").join(every("x", "c1"), "c1")
    out = shared.select("x", "y").unionByName(first.select("x", "y")).unionByName(second.select("x", "y"))
    return out.where("x <> y").distinct()


#: Rows of an entity from which its first one is tried as a pivot; rows that one task compares another with; rows of the first span; how much longer each span reaches than the one before.
HOT, PART, SPAN, GROWTH = 64, 1024, 2048, 8


def spans(rows: DataFrame, least: int, growth: int) -> tuple[Column, int]:
    """(span, number of spans) of rows(id, rank): the order by rank and id, cut so that each span reaches about `growth` times as far as the one before. Where exactly the cuts lie matters to speed alone."""
    n = size = rows.count()
    sizes: list[int] = []
    while size // growth >= least:
        size //= growth
        sizes.append(size)
    if not sizes:
        return F.lit(0), 1
    at = rows.agg(F.percentile_approx("rank", [k / n for k in sizes])).first()[0]
    counts = rows.agg(*(c for r in at for c in (F.count_if(F.col("rank") < r), F.count_if(F.col("rank") == r)))).first()
    within = [min(1.0, max(0.0, (k - counts[2 * i]) / max(1, counts[2 * i + 1]))) for i, k in enumerate(sizes)]
    ids = rows.agg(*(F.percentile_approx(F.when(F.col("rank") == r, F.col("id")), g) for r, g in zip(at, within))).first()
    return sum((((F.col("rank") > r) | ((F.col("rank") == r) & (F.col("id") > i))).cast("int") for r, i in zip(at, ids)), F.lit(0)), len(sizes) + 1


def like_keys(heads: DataFrame, threshold: float, least: int = SPAN, growth: int = GROWTH) -> DataFrame:
    """(lo, hi): of heads(id, rank, tokens, numbers, entities), the rows that merge, each with the earliest kept row of like tokens that neither numbers nor entities hold apart from it.

    Rows with entities meet by one that they share (and by a number, where both have some), those
    without meet all others by rare tokens. The order is cut into spans, each several times as long
    as all before it: a span is resolved, and later rows meet only what it kept, so a row that has
    been merged is compared no more, and most rows are by the first spans. In a span the first row
    of a common entity is a pivot; one that has no like row before it is kept for certain, so rows
    like it are merged for certain and are left out as hi: a group of near copies makes no pair for
    each two rows.
    """
    cut, n_spans = spans(heads.select("id", "rank"), least, growth)
    told = stored(heads.select("id", "rank", cut.alias("span"), F.size("tokens").alias("n"), *signature(F.col("tokens")), F.array_distinct("entities").alias("entities"), "numbers"))
    named = told.where(F.size("entities") > 0).withColumn("entity", F.explode("entities")).drop("entities")
    common = named.groupBy("entity").agg(F.count("*").alias("df")).where("df > 1").select("entity", F.ceil(F.col("df") / PART).cast("int").alias("parts"))
    buckets = stored(named.join(common, "entity"))
    bare, own = F.size("numbers") == 0, F.transform("numbers", lambda x: F.concat(F.lit("n"), x))

    def keyed(df: DataFrame, k: int, tags: Column) -> DataFrame:
        part = F.array(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")) if k == 1 else F.sequence(F.lit(0), F.col("parts") - 1)
        df = df.select("entity", *(F.col(x).alias(f"{x}{k}") for x in ("id", "rank", "n", *SIGNATURE)), F.explode(tags).alias("tag"), part.alias("part"))
        return df.withColumn("part", F.explode("part"))

    full = heads.select("id", "tokens", "numbers", "entities")

    def checked(pairs: DataFrame) -> DataFrame:
        both = pairs.distinct().join(full.withColumnRenamed("id", "lo"), "lo").join(full.select(F.col("id").alias("hi"), F.col("tokens").alias("tokens2"), F.col("numbers").alias("numbers2"), F.col("entities").alias("entities2")), "hi")
        return both.where(~_conflict()).where(jaccard(F.col("tokens"), F.col("tokens2")) >= threshold).select("lo", "hi")

    def meet(lower: DataFrame, upper: DataFrame) -> DataFrame:
        a = keyed(lower, 1, F.when(bare, lit_array(("any",))).otherwise(F.array_append(own, F.lit("none"))))
        b = keyed(upper, 2, F.when(bare, lit_array(("any", "none"))).otherwise(F.array_append(own, F.lit("any"))))
        later = (F.col("rank1") > F.col("rank2")) | ((F.col("rank1") == F.col("rank2")) & (F.col("id1") > F.col("id2")))
        return checked(a.join(b, ["entity", "tag", "part"]).where(later & may_be_similar(threshold)).select(F.col("id1").alias("lo"), F.col("id2").alias("hi")))

    # rows without entities, against all
    plain = told.where(F.size("entities") == 0).select(F.col("id").alias("c"))
    loose: DataFrame | None = None
    if plain.limit(1).count():
        sets = prefixes(heads.select(F.col("id").alias("c"), F.size("tokens").alias("n"), "tokens"), threshold)
        ranks = lambda k: told.select(F.col("id").alias(f"c{k}"), F.col("rank").alias(f"r{k}"))
        met = prefix_meet(sets.join(plain, "c", "left_semi"), sets, threshold).select("c1", "c2").distinct().join(ranks(1), "c1").join(ranks(2), "c2")
        later = F.struct(F.col("r1").alias("r"), F.col("c1").alias("i")) > F.struct(F.col("r2").alias("r"), F.col("c2").alias("i"))
        loose = stored(checked(met.select(F.when(later, F.col("c1")).otherwise(F.col("c2")).alias("lo"), F.when(later, F.col("c2")).otherwise(F.col("c1")).alias("hi"))))

    def pairs(lower: DataFrame, upper: DataFrame) -> DataFrame:
        """All like pairs of two tables of ids."""
        found = meet(buckets.join(lower, "id", "left_semi"), buckets.join(upper, "id", "left_semi"))
        if loose is None:
            return found
        return found.unionByName(loose.join(lower.withColumnRenamed("id", "lo"), "lo", "left_semi").join(upper.withColumnRenamed("id", "hi"), "hi", "left_semi")).distinct()

    def inside(now: DataFrame) -> DataFrame:
        """(lo, matched_to) among the rows of a span that none before it merged."""
        firsts = buckets.join(now, "id", "left_semi").groupBy("entity").agg(F.count("*").alias("df"), F.min(F.struct("rank", "id")).alias("f")).where(F.col("df") > HOT)
        pivots = stored(firsts.select(F.col("f.id").alias("id")).distinct())
        upper = now
        if pivots.limit(1).count():
            sure = stored(pivots.join(pairs(pivots, now).select(F.col("lo").alias("id")), "id", "left_anti"))
            upper = now.join(stored(pairs(now, sure).select(F.col("lo").alias("id")).distinct()), "id", "left_anti")
        return stored(resolve(_edges(pairs(now, upper), told)))

    found: list[DataFrame] = []
    open_ = told.select("id", "span")
    for k in range(n_spans):
        now = stored(open_.where(F.col("span") == k).select("id"))
        found.append(inside(now))
        if k < n_spans - 1:
            kept = stored(now.join(found[-1].select(F.col("lo").alias("id")), "id", "left_anti"))
            later = open_.where(F.col("span") > k)
            found.append(stored(_edges(pairs(later.select("id"), kept), told).groupBy("lo").agg(F.min_by("hi", F.struct("rank", "hi")).alias("matched_to"))))
            open_ = stored(later.join(found[-1].select(F.col("lo").alias("id")), "id", "left_anti"))
    return reduce(DataFrame.unionByName, found).select("lo", F.col("matched_to").alias("hi"))


def key_similarity(rows: DataFrame, cfg: Config) -> DataFrame:
    """rows(id, rank, dedupe_key, numbers, entities): equal keys, then keys with like bigrams; both vetoed by numbers or entities that contradict."""
    if cfg.key_threshold <= 0:
        return merged_into(rows, rows.select(F.col("id").alias("lo"), F.col("id").alias("matched_to")).limit(0), "key_similarity")
    exact = stored(exact_keys(rows))
    left = rows.join(exact.select(F.col("lo").alias("id")), "id", "left_anti")
    # rows with the same bigrams, numbers and entities are one class
    told = left.withColumns({"tokens": key_ngrams(F.col("dedupe_key")), "numbers": F.array_sort("numbers"), "entities": F.array_sort("entities")})
    told = stored(told.where(F.size("tokens") > 0).select("id", "rank", F.array_sort(F.array_distinct("tokens")).alias("tokens"), "numbers", "entities"))
    heads = stored(told.groupBy("tokens", "numbers", "entities").agg(F.min(F.struct("rank", "id")).alias("f")).select("f.id", "f.rank", "tokens", "numbers", "entities"))
    found = like_keys(heads, cfg.key_threshold).withColumnRenamed("hi", "matched_to")
    firsts = told.join(heads.select("tokens", "numbers", "entities", F.col("id").alias("head")), ["tokens", "numbers", "entities"])
    out = firsts.join(found.select(F.col("lo").alias("head"), "matched_to"), "head", "left").select(F.col("id").alias("lo"), F.coalesce("matched_to", "head").alias("matched_to")).where("lo <> matched_to")
    return merged_into(rows, exact.unionByName(out), "key_similarity")


def key_prefixes(rows: DataFrame, tokens: int = 3) -> DataFrame:
    """Every row after the first of its key prefix is merged."""
    prefix = F.array_join(F.slice(key_tokens(F.col("dedupe_key")), 1, tokens), "-")
    w = Window.partitionBy("prefix").orderBy("rank", "id")
    df = rows.withColumn("prefix", prefix).where("prefix <> ''").withColumn("first", F.first("id").over(w))
    return merged_into(rows, df.where("id <> first").select(F.col("id").alias("lo"), F.col("first").alias("matched_to")), "key_prefix")


NUMBER = r"([$€£¥₩]|usd|eur|gbp|jpy|krw)?\s*(\d+(?:\.\d+)?)\s*(billion|million|trillion|thousand|percent|usd|eur|gbp|jpy|krw|%|dollars?|won|bn|mn|억|만|조|달러|원)?"


def _number_tokens(text: Column, cfg: Config) -> Column:
    """Numbers with currency and magnitude in one spelling each: with both, also the one without the currency; no dates."""
    aliases = F.create_map(*[F.lit(x) for pair in cfg.unit_aliases for x in pair])
    flat = F.regexp_replace(text, ",", "")
    parts = [F.regexp_extract_all(flat, F.lit(NUMBER), F.lit(k)) for k in (1, 2, 3)]
    spelt = lambda u: F.coalesce(F.try_element_at(aliases, u), u)

    def told(x: Column) -> Column:
        unit = lambda field, money: F.when(spelt(x[field]).isin(*cfg.currencies) == money, spelt(x[field])).otherwise("")
        money, size = F.coalesce(falsy(unit("0", True)), unit("2", True)), F.coalesce(falsy(unit("2", False)), unit("0", False))
        return bound(F.struct(money.alias("m"), size.alias("s")), lambda u: F.array_distinct(F.array(F.concat(x["1"], u["m"], u["s"]), F.when((u["m"] != "") & (u["s"] != ""), F.concat(x["1"], u["s"])).otherwise(F.concat(x["1"], u["m"], u["s"])))))

    return F.array_distinct(F.flatten(F.transform(F.filter(F.arrays_zip(*(p.alias(str(k)) for k, p in enumerate(parts))), lambda x: ~is_date_like(x["1"])), told)))


def informs(title: Column, summary: Column, text: Column, cfg: Config) -> Column:
    """What an article tells: struct of numbers, entities, stages and results. Only the first 2,000 characters of title, summary and body count, a rule of the operator."""
    low = F.lower(F.substring(collapse(F.concat_ws(" ", title, summary, text)), 1, 2000))
    names = F.array_union(normal_tokens(title, cfg), normal_tokens(summary, cfg))
    said = lambda c, words: F.filter(lit_array(words), lambda w: F.contains(F.concat(F.lit(" "), F.regexp_replace(c, "[^a-z0-9가-힣]", " "), F.lit(" ")), F.concat(F.lit(" "), w, F.lit(" "))))
    return bound(low, lambda c: F.struct(_number_tokens(c, cfg).alias("numbers"), F.filter(names, lambda t: ~is_noise(t, cfg) & ~is_date_like(t)).alias("entities"), said(c, cfg.structural).alias("stages"), said(c, cfg.actions).alias("results")))


def adds_information(later: Column, earlier: Column) -> Column:
    more = lambda f: F.size(F.array_except(later[f], earlier[f])) > 0
    return more("numbers") | more("entities") | more("stages") | more("results")


def semantic(rows: DataFrame, pairs: DataFrame, cfg: Config, relaxed: bool = False) -> DataFrame:
    """rows(id, rank, cluster_key, key_prefix, words, told), pairs(lo, hi, cosine) over bounded candidates; a later row that adds information stays.

    Rows with two different cluster keys need equal prefixes or half of the smaller one's words in
    common, and then less likeness. A row without a cluster key differs from none, an empty prefix
    equals none. The relaxed pass asks for likeness alone.
    """
    side = lambda k: rows.select(*(F.col(c).alias(f"{c}{k}") for c in ("id", "cluster_key", "key_prefix", "words", "told")))
    df = pairs.join(side(1).withColumnRenamed("id1", "lo"), "lo").join(side(2).withColumnRenamed("id2", "hi"), "hi")
    if relaxed:
        ok = F.col("cosine") >= cfg.semantic_relaxed
    else:
        key = lambda k: F.coalesce(f"cluster_key{k}", F.lit(""))
        apart = (key(1) != "") & (key(2) != "") & (key(1) != key(2))
        same_prefix = (F.coalesce("key_prefix1", F.lit("")) != "") & (F.col("key_prefix1") == F.col("key_prefix2"))
        smaller = F.least(F.size("words1"), F.size("words2"))
        alike = (smaller > 0) & (F.size(F.array_intersect("words1", "words2")) >= 0.5 * smaller)
        ok = F.when(apart, (same_prefix | alike) & (F.col("cosine") >= max(0.82, cfg.semantic_strict - 0.03))).otherwise(F.col("cosine") >= cfg.semantic_strict)
    edges = df.where(ok & ~adds_information(F.col("told1"), F.col("told2"))).select("lo", "hi")
    return merged_into(rows, resolve(_edges(edges, rows)), "semantic_duplicate")


def semantic_passes(rows: DataFrame, pairs: DataFrame, cfg: Config) -> DataFrame:
    """The strict pass, then the relaxed one over the rows that it kept."""
    first = stored(semantic(rows, pairs, cfg).select("id", "status", "merge_reason", "matched_to"))
    left = rows.join(first.where("status = 'kept'").select("id"), "id", "left_semi")
    among = pairs.join(left.select(F.col("id").alias("lo")), "lo", "left_semi").join(left.select(F.col("id").alias("hi")), "hi", "left_semi")
    second = semantic(left, among, cfg, relaxed=True).select("id", "status", "merge_reason", "matched_to")
    return first.where("status = 'merged'").unionByName(second)


def passes(rows: DataFrame, cfg: Config) -> DataFrame:
    """(id, status, merge_reason, matched_to) after title, cluster, entity and key passes, each over the rows that the one before kept.

    rows(id, arrival, rank, title, dedupe_key, cluster_key, entities, events, action, numbers) are the
    recorded ones: those that pass the filters. Titles are compared in order of arrival, all else by rank.
    """
    now = stored(rows)
    steps = (
        lambda df: title_duplicates(df.select("id", F.col("arrival").alias("rank"), "title"), cfg),
        lambda df: cluster_duplicates(df.select("id", "rank", "title", "dedupe_key", "cluster_key"), cfg),
        lambda df: entity_events(df.select("id", "rank", "entities", "events", "action"), cfg),
        lambda df: key_similarity(df.select("id", "rank", "dedupe_key", "numbers", "entities"), cfg),
    )
    out: DataFrame | None = None
    for step in steps:
        told = stored(step(now).select("id", "status", "merge_reason", "matched_to"))
        gone = told.where("status = 'merged'")
        out = gone if out is None else out.unionByName(gone)
        now = stored(now.join(gone.select("id"), "id", "left_anti"))
    none = F.lit(None)
    return out.unionByName(now.select("id", F.lit("kept").alias("status"), none.cast("string").alias("merge_reason"), none.cast(dict(rows.dtypes)["id"]).alias("matched_to")))


def unique_keys(rows: DataFrame, reference_rule: bool = False) -> DataFrame:
    """The best row of each key by (quality ok, tier, importance, newest). Rows without a key stay, unless the old rule is asked for; they pass no window."""
    w = Window.partitionBy("dedupe_key").orderBy(F.desc(F.col("quality") == "ok"), F.desc("tier"), F.desc("importance"), F.desc("published_at"), "id")
    blank = F.coalesce("dedupe_key", F.lit("")) == ""
    best = rows.where(~blank).withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
    return best if reference_rule else best.unionByName(rows.where(blank))
