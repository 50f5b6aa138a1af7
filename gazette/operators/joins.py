"""Joins: lookups by key, and exact similarity joins on tokens and vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from gazette.functions.text import jaccard


def history_lookup(items: DataFrame, history: DataFrame) -> DataFrame:
    """matched_to: the id of a recent row with the same cluster key (history has one row per key)."""
    return items.join(history.select("cluster_key", F.col("item_id").alias("matched_to")), "cluster_key", "left")


def body_join(items: DataFrame, pages: DataFrame, least: int = 300, budget: int = 200) -> DataFrame:
    """Bodies for rows that lack one: each link once, the best-scored `budget` links; other rows stay as they are."""
    lacking = items.where(F.length(F.coalesce("full_text", F.lit(""))) < least)
    links = lacking.groupBy("link").agg(F.max("score").alias("s")).orderBy(F.desc("s"), "link").limit(budget)
    found = pages.join(links.select(F.col("link").alias("url")), "url", "left_semi").dropDuplicates(["url"]).select(F.col("url").alias("link"), "body")
    short = F.length(F.coalesce("full_text", F.lit(""))) < least
    return items.join(found, "link", "left").withColumn("full_text", F.when(short & F.col("body").isNotNull(), F.col("body")).otherwise(F.col("full_text"))).drop("body")


def cluster_first(rows: DataFrame) -> DataFrame:
    """matched_to of merged rows: the first kept row of their cluster."""
    kept = rows.where("status = 'kept'").groupBy("cluster_key").agg(F.min_by("item_id", "pos").alias("first"))
    return rows.join(kept, "cluster_key", "left").withColumn("matched_to", F.when(F.col("status") == "merged", F.coalesce("first", "matched_to")).otherwise(F.col("matched_to"))).drop("first")


def related(items: DataFrame, top: DataFrame, most: int) -> DataFrame:
    """Items that share the cluster key or the key's first three tokens with the top ones; the best `most` of them."""
    others = items.join(top.select("item_id"), "item_id", "left_anti")
    by_cluster = others.join(top.select("cluster_key").distinct(), "cluster_key", "left_semi")
    by_prefix = others.where("key_prefix <> ''").join(top.select("key_prefix").distinct(), "key_prefix", "left_semi")
    return by_cluster.unionByName(by_prefix.select(*by_cluster.columns)).dropDuplicates(["item_id"]).orderBy(F.desc("score"), "item_id").limit(most)


def not_kept(eligible: DataFrame, kept: DataFrame) -> DataFrame:
    return eligible.join(kept.select("item_id"), "item_id", "left_anti")


def _distinct_sets(sets: DataFrame, rank: str) -> tuple[DataFrame, DataFrame]:
    one = sets.select("id", F.col(rank).alias("rank"), F.sort_array(F.array_distinct("tokens")).alias("tokens")).where(F.size("tokens") > 0)
    return one, one.groupBy("tokens").agg(F.min(F.struct("rank", "id")).alias("first")).select(F.col("first.id").alias("c"), F.col("first.rank").alias("rank"), "tokens", F.size("tokens").alias("n"))


def equal_sets(sets: DataFrame, rank: str = "rank") -> DataFrame:
    """(id, first): for every row with a non-empty set, the first row that has the same one."""
    one, classes = _distinct_sets(sets, rank)
    return one.join(classes.select("tokens", F.col("c").alias("first")), "tokens").select("id", "first")


SIGNATURE = ("p0", "p1", "p2", "p3")


def signature(tokens: Column) -> list[Column]:
    """256 bits as four numbers: a bit is the parity of the set's tokens that hash to it, so two sets differ in at least as many tokens as in bits."""
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))
    word = lambda k: F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: F.when(F.shiftright(h, 6).bitwiseAND(F.lit(3)) == k, s.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))).otherwise(s))
    return [word(k).alias(name) for k, name in enumerate(SIGNATURE)]


def may_be_similar(threshold: float) -> Column:
    """Whether sizes n1, n2 and signatures leave room for the threshold. It lets every similar pair through."""
    apart = sum((F.bit_count(F.col(f"{p}1").bitwiseXOR(F.col(f"{p}2"))) for p in SIGNATURE), F.lit(0))
    return (F.least("n1", "n2") >= threshold * F.greatest("n1", "n2") - 1e-9) & (apart * (1 + threshold) <= (F.col("n1") + F.col("n2")) * (1 - threshold) + 1e-6)


def prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(c, n, i, token, signature) for the first n - ceil(t n) + 1 tokens of sets(c, n, tokens), from rare to frequent; tokens of one set alone are left out."""
    exploded = sets.select("c", "n", F.explode("tokens").alias("token"))
    frequency = exploded.groupBy("token").agg(F.count("*").alias("df"))
    ordered = exploded.join(frequency, "token").groupBy("c").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("o"))
    ordered = ordered.select("c", "n", "o", *signature(F.col("o.token")))
    return ordered.select("c", "n", *SIGNATURE, F.posexplode(F.slice("o", F.lit(1), (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1).cast("int"))).alias("i", "x")).where("x.df > 1").select("c", "n", *SIGNATURE, "i", F.col("x.token").alias("token"))


def prefix_meet(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """(c1, c2, i1, n1, ...): rows of prefixes() that share a token and may be similar by place, size and signature."""
    side = lambda df, k: df.select(*(F.col(x).alias(f"{x}{k}") for x in ("c", "n", "i", *SIGNATURE)), "token")
    most = F.least(F.col("i1"), F.col("i2")) + 1 + F.least(F.col("n1") - F.col("i1") - 1, F.col("n2") - F.col("i2") - 1)
    return side(a, 1).join(side(b, 2), "token").where((F.col("c1") != F.col("c2")) & (most * (1 + threshold) >= threshold * (F.col("n1") + F.col("n2")) - 1e-6) & may_be_similar(threshold))


def set_similarity_join(sets: DataFrame, threshold: float, rank: str = "rank") -> DataFrame:
    """(lo, hi, similarity): pairs of different token sets of (id, rank, tokens) with Jaccard >= threshold, each named by its first row; hi has the smaller rank.

    Copies aren't expanded: equal_sets() says which rows share a set. Tokens are ordered from rare
    to frequent, and two sets that are similar enough share one in their first
    n - ceil(t n) + 1 tokens; only those are joined, and pairs that their signatures hold apart go
    before they are shuffled. Empty sets match nothing.
    """
    _, classes = _distinct_sets(sets, rank)
    prefix = prefixes(classes, threshold)
    candidates = prefix_meet(prefix, prefix, threshold).where("c1 < c2").select("c1", "c2").distinct()
    side = lambda k: classes.select(F.col("c").alias(f"c{k}"), F.col("tokens").alias(f"t{k}"))
    similar = candidates.join(side(1), "c1").join(side(2), "c2").select("c1", "c2", jaccard(F.col("t1"), F.col("t2")).alias("similarity")).where(F.col("similarity") >= threshold)
    ranks = lambda k: classes.select(F.col("c").alias(f"c{k}"), F.col("rank").alias(f"r{k}"))
    named = similar.join(ranks(1), "c1").join(ranks(2), "c2")
    first = F.struct(F.col("r1").alias("r"), F.col("c1").alias("id")) < F.struct(F.col("r2").alias("r"), F.col("c2").alias("id"))
    return named.select(F.when(first, F.col("c2")).otherwise(F.col("c1")).alias("lo"), F.when(first, F.col("c1")).otherwise(F.col("c2")).alias("hi"), "similarity")


def unit(c: Column) -> Column:
    """The vector divided by its length, in double; null for zero and empty vectors."""
    d = F.transform(c, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm))


def cosine(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


#: Most bytes that Spark hands over to a Python worker at once, unless the session sets another size.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def _products(threshold: float, schema: pa.Schema):
    """For mapInArrow: pairs of blocks (query ids, their vectors, ids, their vectors), the vectors of a block end to end, to the pairs that reach the threshold."""

    def of(batches):
        for batch in batches:
            queries, units, ids, others = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                q, v = queries[k].values, ids[k].values
                a, b = (x[k].values.to_numpy(zero_copy_only=False) for x in (units, others))
                if len(a) * len(v) != len(b) * len(q):  # vectors of other lengths have no cosine
                    continue
                a, b = a.reshape(len(q), -1), b.reshape(len(v), -1)
                # the product says which pairs are near the threshold; these are summed in order of place, as cosine() does
                near = ~(a @ b.T < threshold - 1e-9)
                rows, places = np.nonzero(near)
                for at in range(0, len(rows), 1 << 14):
                    i, j = rows[at : at + (1 << 14)], places[at : at + (1 << 14)]
                    cosines = np.cumsum(a[i] * b[j], axis=1)[:, -1]
                    good = ~(cosines < threshold)
                    found = pa.RecordBatch.from_arrays([q.take(pa.array(i[good])), v.take(pa.array(j[good])), pa.array(cosines[good])], schema=schema)
                    same = pc.equal(found.column(0), found.column(1))
                    yield found.filter(pc.invert(same))

    return of


def cosine_join(vectors: DataFrame, queries: DataFrame, threshold: float, block: int = 2048) -> DataFrame:
    """(query, id, cosine) for a stated set of queries against all vectors of the same length.

    Both sides are packed into blocks of about `block` vectors. Each pair of blocks is one matrix
    product, and the pairs of blocks are dealt over all tasks; none holds more than a few blocks.
    """
    spark = vectors.sparkSession
    if spark.conf.get(BATCH_SETTING) == f"{64 << 20}b":  # Spark's own size
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")

    def packed(df: DataFrame, ids: str, units: str) -> DataFrame:
        parts = -(-df.count() // block) or 1
        rows = df.select("id", unit(F.col("vector")).alias("u")).where("id IS NOT NULL AND size(u) > 0").withColumn("d", F.size("u"))
        rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).repartition(parts, "part", "d")
        return rows.groupBy("part", "d").agg(F.collect_list(F.struct("id", "u")).alias("rows")).select(F.col("rows.id").alias(ids), F.flatten("rows.u").alias(units))

    schema = StructType([StructField("query", queries.schema["id"].dataType), StructField("id", vectors.schema["id"].dataType), StructField("cosine", DoubleType())])
    pairs = packed(queries, "queries", "units").crossJoin(packed(vectors, "ids", "others"))
    return pairs.mapInArrow(_products(threshold, to_arrow_schema(schema)), schema)


def pair_overlap(pairs: DataFrame) -> DataFrame:
    """Overlap measures for a table of token-set pairs (a, b)."""
    both = F.size(F.array_intersect("a", "b"))
    return pairs.select(
        "*", both.alias("n_both"), F.size(F.array_union("a", "b")).alias("n_union"), F.size(F.array_except("a", "b")).alias("n_only_a"), (F.size(F.array_except("a", "b")) == 0).alias("a_in_b"),
        F.when(F.least(F.size("a"), F.size("b")) > 0, both / F.least(F.size("a"), F.size("b"))).otherwise(F.lit(0.0)).alias("overlap"),
    )
