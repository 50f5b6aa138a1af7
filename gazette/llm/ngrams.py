"""N-gram Jaccard join (operator 1): documents whose sets of k-word shingles are alike.

Two documents link when 100 * |A and B| >= percent * |A or B|; five words and 80 unless the
caller says otherwise. Each set is put in one global order, rare shingles first, and only its
prefix (the first n - ceil(n * percent / 100) + 1) can hold the first shingle that it shares
with a partner. Documents with equal sets are one from then on.

* Order: a bounded table (`hot_most`) of the most frequent shingles, counted over all
  documents, puts these last, the most frequent at the very end; others go by hash. The order
  decides how many candidates there are, never which links are found.
* Hub round: in each prefix shingle's bucket every document is paired with the bucket's hub
  only (the one with the fewest shingles of its own before it), which is linear in the bucket.
* Rest round: where a bucket still holds several components, the documents outside its
  largest one are paired with the bucket's documents of other components. A pair inside one
  component can't change the result, so after this round no link can be missing. Pairs that
  the hub round has tested aren't tested again.
* Filters: length and position on the shingles' places, then the suffix filter. That one cuts the
  space of hashes into 2,048 ranges; two sets differ by at least as many shingles as there are
  ranges whose counts differ in parity. Its folded form (512 ranges) is part of the rest round's
  join condition, so a pair that fails is never a row; the full one is tested once per pair.
  What is left is verified once, by the exact intersection.

joined() finds components without ever making all pairs of a group, since a third of all rows
may be one. links() is the join itself, for results whose size is wanted: every link between
different sets, once.

Defined cases: null, empty and blank texts have no shingles and link with nothing; texts of
fewer than k words have their whole sequence as one shingle; of the rows that repeat a doc_id the
longest text counts (of equally long ones the one with the larger hash), in one row of the result;
rows without a doc_id are returned each for itself, linked with nothing, and deduplicated() keeps
them; other columns go.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, drop_written, grams, id_bits, in_bits, lower_ascii, mix, raw, released, span_hashes, texts, words, written
from .graph import components

K, PERCENT = 5, 80
SIGNATURE = 2048


def shingle_sets(text: pa.Array, k: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its k-word shingles."""
    body, offsets = raw(text)
    body = lower_ascii(body)
    starts, ends, rows = words(body, offsets)
    h = span_hashes(body, starts, ends)
    g, at = grams(h, rows, k)
    bounds = np.searchsorted(rows[at], np.arange(len(text) + 1))
    counts = np.bincount(rows, minlength=len(text))
    begins = np.cumsum(counts) - counts
    out = []
    for r in range(len(text)):
        if counts[r] >= k:
            out.append(np.unique(g[bounds[r] : bounds[r + 1]]))
        elif counts[r]:  # the whole sequence, told apart from shingles by its length
            v = np.array([counts[r]], np.uint64)
            for x in h[begins[r] : begins[r] + counts[r]]:
                v = mix(v * np.uint64(0x9E3779B97F4A7C15) + x)
            out.append(v)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def hot_shingles(docs: DataFrame, k: int, hot_most: int, per_task: int = 1 << 21, least: int = 3) -> np.ndarray:
    """The most frequent shingles, the rarest of them first. Each task counts its own and sends those it saw often; all documents count."""

    def counted(held: list[np.ndarray]):
        g, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= least
        return pa.RecordBatch.from_arrays([pa.array(g[often].view(np.int64)), pa.array(n[often], pa.int64())], ["g", "n"])

    def run(batches):
        held, size = [], 0
        for _, text in chunks(batches):
            sets = shingle_sets(text, k)
            held += sets
            size += sum(map(len, sets))
            if size >= per_task:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    best = texts(docs).mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "g").limit(hot_most)
    rows = best.toArrow()
    g, n = rows["g"].to_numpy(), rows["n"].to_numpy()
    return g[np.lexsort((-g, n))].view(np.uint64)


def _text_order(text: pa.Array) -> list[pa.Array]:
    """What decides between texts of one doc_id: length in bytes, then a hash."""
    body, offsets = raw(text)
    return [pa.array(np.diff(offsets)), pa.array(span_hashes(body, offsets[:-1], offsets[1:]).view(np.int64))]


def prefixes(docs: DataFrame, hot: np.ndarray, k: int, percent: int) -> DataFrame:
    """doc_id, size and h (the text's order among rows of one doc_id), n (set size), k1 and k2 (a 128-bit key of the set), prefix (array<long>) and bits (array<long>)."""
    order = np.argsort(hot)
    shared = docs.sparkSession.sparkContext.broadcast((order.astype(np.int32), hot[order]))

    def run(batches):
        order, known = shared.value
        for ids, text in chunks(batches):
            sets = shingle_sets(text, k)
            sizes = np.array([len(s) for s in sets])
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            rows = np.repeat(np.arange(len(sets)), sizes)
            keys = np.zeros((2, len(sets)), np.uint64)
            for key, salt in zip(keys, (0x1234567, 0xABCDEF01)):
                np.add.at(key, rows, mix(flat + np.uint64(salt)))
            bits = np.bincount(rows * SIGNATURE + (flat >> np.uint64(53)).astype(np.int64), minlength=len(sets) * SIGNATURE) % 2
            packed = np.packbits(bits.astype(np.uint8)).view(np.int64)
            lists, at = [], 0
            for n in sizes.tolist():
                s = flat[at : at + n]  # in order of hash
                at += n
                if n and len(known):
                    where = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    is_hot = known[where] == s
                    if is_hot.any():
                        ranks = order[where[is_hot]]
                        s = np.concatenate([s[~is_hot], s[is_hot][np.argsort(ranks)]])
                lists.append(s[: n - (percent * n + 99) // 100 + 1] if n else s)
            sized = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            pool = (np.concatenate(lists) if lists else np.zeros(0, np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, *_text_order(text), pa.array(sizes, pa.int64()), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.ListArray.from_arrays(pa.array(sized), pa.array(pool)), pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (SIGNATURE // 64)), pa.array(packed))],
                ["doc_id", "size", "h", "n", "k1", "k2", "prefix", "bits"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, size long, h long, n long, k1 long, k2 long, prefix array<long>, bits array<long>")


def _may_link(na: Column, ia: Column, sa: Column, nb: Column, ib: Column, sb: Column, percent: int) -> Column:
    """Length and positional filter for a shingle at the places ia and ib.

    sa and sb are how many of the shingles before it stand in two prefixes or more. Only those
    can be common: one that both sets hold before a common place is in both prefixes.
    """
    most = F.least(sa, sb) + 1 + F.least(na - ia - 1, nb - ib - 1)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * most >= percent * (na + nb))


def _most_apart(na: Column, nb: Column, percent: int) -> Column:
    """How many shingles may stand in only one of two sets that link."""
    both = na + nb
    return both - 2 * F.ceil(percent * both / F.lit(100 + percent) - F.lit(1e-9))


def _chosen_texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(doc_id, text) of the needed documents. Row-local thinning first, an exact join after."""
    bits = docs.sparkSession.sparkContext.broadcast(id_bits(needed))

    def run(batches):
        for batch in batches:
            part = batch.filter(pa.array(in_bits(batch.column("doc_id").to_numpy(), bits.value)))
            if part.num_rows:
                yield pa.RecordBatch.from_arrays([*part.columns, *_text_order(part.column("text"))], ["doc_id", "text", "size", "h"])

    may = texts(docs).where(F.col("doc_id").isNotNull()).mapInArrow(run, "doc_id long, text string, size long, h long")
    return may.join(needed, ["doc_id", "size", "h"], "left_semi").select("doc_id", "text")


@dataclass
class Prepared:
    """What both the join and the components start from; close() removes the tables."""

    every: DataFrame  # doc_id, size, h, n, k1, k2 of every document that has an id
    repeats: bool  # whether a doc_id stands in several rows
    unnamed: DataFrame  # n of every row without one
    classes: DataFrame  # n, k1, k2 and the smallest doc_id (first) of each distinct set
    firsts: DataFrame  # doc_id, n, bits of the classes' first documents
    shared: DataFrame  # token, doc_id, n, i, s: prefix shingles that two classes or more hold
    tables: list[DataFrame]

    def close(self) -> None:
        for t in self.tables:
            drop_written(t)


def _near_pairs(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the suffix filter."""
    side = lambda x: firsts.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    apart = F.aggregate(F.zip_with("bitsa", "bitsb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(apart <= _most_apart(F.col("na"), F.col("nb"), percent)).select("a", "b")


def _verified(near: DataFrame, p: Prepared, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by the exact intersection."""
    ends = near.select(F.col("a").alias("doc_id")).union(near.select(F.col("b").alias("doc_id"))).distinct()
    text = _chosen_texts(docs, p.every.join(ends, "doc_id", "left_semi").select("doc_id", "size", "h"))
    if p.repeats:
        text = text.dropDuplicates(["doc_id"])  # equal rows
    text = written(text, "texts")
    one = lambda x: text.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))

    def run(batches):
        for batch in batches:
            step = 256
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                left, right = shingle_sets(part.column("text_a"), k), shingle_sets(part.column("text_b"), k)
                keep = []
                for x, y in zip(left, right):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    out = written(near.join(one("a"), "a").join(one("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "links")
    drop_written(text)
    return out


def prepared(docs: DataFrame, k: int, percent: int, hot_most: int) -> Prepared:
    sets = written(prefixes(docs, hot_shingles(docs, k, hot_most), k, percent), "sets")
    every = written(sets.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("size", "h", "n", "k1", "k2")).alias("s"), F.count("*").alias("c")).select("doc_id", "s.*", "c"), "every")
    classes = every.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("first"))
    repeats = not every.where("c > 1").isEmpty()
    once = lambda df, *key: df.dropDuplicates(list(key)) if repeats else df
    firsts = sets.join(classes.select(F.col("first").alias("doc_id"), "n", "k1", "k2"), ["doc_id", "n", "k1", "k2"], "left_semi")

    tokens = firsts.select("doc_id", "n", F.posexplode("prefix").alias("i", "token"))
    twice = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    known = written(tokens.join(twice, "token"), "tokens")
    before = F.row_number().over(Window.partitionBy("doc_id").orderBy("i", "token")) - 1
    shared = written(once(known, "doc_id", "token").withColumn("s", before), "shared")
    drop_written(known)
    return Prepared(every, repeats, sets.where("doc_id IS NULL").select("n"), classes, once(firsts.select("doc_id", "n", "bits"), "doc_id"), shared, [sets, every, shared])


#: Longs of the suffix filter's folded form.
FOLDED = 8


def _folded(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """rows with the folded suffix filter of their document, as the columns f0 to f7: ranges whose numbers agree modulo 512 are one."""
    long = lambda i: F.get("bits", F.lit(i))
    fold = [reduce(Column.bitwiseXOR, [long(i + FOLDED * j) for j in range(SIGNATURE // 64 // FOLDED)]).alias(f"f{i}") for i in range(FOLDED)]
    return rows.join(firsts.select("doc_id", *fold), "doc_id")


def _side(rows: DataFrame, x: str, *more: Column) -> DataFrame:
    return rows.select(F.col("token").alias(f"t{x}"), F.col("doc_id").alias(x), *(F.col(c).alias(f"{c}{x}") for c in ("n", "i", "s", *(f"f{i}" for i in range(FOLDED)))), *more)


def _near(percent: int) -> Column:
    """The join condition of two sides: length, position and the folded suffix filter."""
    apart = sum((F.bit_count(F.col(f"f{i}a").bitwiseXOR(F.col(f"f{i}b"))) for i in range(1, FOLDED)), F.bit_count(F.col("f0a").bitwiseXOR(F.col("f0b"))))
    return _may_link(*map(F.col, ("na", "ia", "sa", "nb", "ib", "sb")), percent) & (apart <= _most_apart(F.col("na"), F.col("nb"), percent))


def links(docs: DataFrame, k: int = K, percent: int = PERCENT, hot_most: int = 1 << 17) -> tuple[DataFrame, DataFrame]:
    """The whole join: (a, b), a < b, for every two classes of equal sets that link, named by their smallest doc_id; and (doc_id, class) of every document."""
    p = prepared(docs, k, percent, hot_most)
    rows = written(_folded(p.shared, p.firsts), "folded")
    a, b = _side(rows, "a"), _side(rows, "b")
    pairs = a.join(b, (F.col("ta") == F.col("tb")) & (F.col("a") < F.col("b")) & _near(percent)).select("a", "b").distinct()
    pairs = written(_near_pairs(pairs, p.firsts, percent), "pairs")
    out = _verified(pairs, p, docs, k, percent)
    members = written(p.every.join(p.classes, ["n", "k1", "k2"], "left").select("doc_id", F.coalesce("first", "doc_id").alias("class")), "members")
    drop_written(rows)
    drop_written(pairs)
    p.close()
    return out, members


def joined(docs: DataFrame, k: int = K, percent: int = PERCENT, hot_most: int = 1 << 17) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    spark: SparkSession = docs.sparkSession
    p = prepared(docs, k, percent, hot_most)
    shared = p.shared
    hubs = shared.groupBy("token").agg(F.min(F.struct((F.col("i") - F.col("s")).alias("own"), "doc_id", "n", "i", "s")).alias("hub"))
    released(spark)
    pairs = shared.join(hubs, "token").where(F.col("doc_id") != F.col("hub.doc_id")).where(_may_link(F.col("n"), F.col("i"), F.col("s"), F.col("hub.n"), F.col("hub.i"), F.col("hub.s"), percent)).select(F.least("doc_id", "hub.doc_id").alias("a"), F.greatest("doc_id", "hub.doc_id").alias("b"))
    pairs = written(pairs.distinct(), "pairs")
    near = written(_near_pairs(pairs, p.firsts, percent), "near")
    found = _verified(near, p, docs, k, percent)
    released(spark)
    groups = components(found)

    own = shared.join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    parts = own.groupBy("token", "component").agg(F.count("*").alias("c"))
    mixed = parts.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("c", "component")).alias("m")).where("parts > 1").select("token", F.col("m.component").alias("main"))
    open_ = written(_folded(own.join(mixed, "token"), p.firsts), "open")
    minor = _side(open_.where("component <> main"), "a", F.col("component").alias("ca"))
    other = _side(open_, "b", F.col("component").alias("cb"), "main")
    apart = (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b")))
    rest = minor.join(other, (F.col("ta") == F.col("tb")) & apart & _near(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = written(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
    more = _verified(rest, p, docs, k, percent)
    released(spark)
    linked = components(found.unionByName(more)) if not more.isEmpty() else groups
    for t in (open_, rest, pairs, near):
        drop_written(t)

    of_class = p.classes.join(linked.select(F.col("node").alias("first"), "component"), "first", "left").select("n", "k1", "k2", F.coalesce("component", "first").alias("component_id"))
    out = p.every.join(of_class, ["n", "k1", "k2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.unionByName(p.unnamed.select(F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id; so do rows without a doc_id. All columns stay."""
    gone = joined(docs, **options).where("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
