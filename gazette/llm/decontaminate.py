"""Benchmark decontamination (operator 7): greedy string tiling.

Seeds are the Karp-Rabin hashes of 5 neighbouring words. Those of the test items form a table;
documents send only seeds that may be in it (a bit map of fixed size, built by a Spark
aggregate), and the two tables are joined on the seed. For each pair of a document and an item
the longest match that overlaps no marked word is marked, again and again, down to 5 words; the
share of the item's words that are marked is its coverage, so a passage whose parts were moved
about is still found. Pairs from `threshold` on are reported.

Nothing of the benchmark but the bit map passes through the driver. Pairs that share too few
seeds to reach the threshold are dropped before they are tiled.

Defined cases: items of fewer than 5 words (`least`) match nothing, since a word or two tell
nothing about where a text is from; documents without words match nothing; item ids that repeat
with other texts are items of their own, reported by the best coverage; so are rows that repeat a
doc_id; a row without a doc_id is reported with a null one; clean() judges each row by its text.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, grams, id_bits, in_bits, lower_ascii, raw, span_hashes, texts, words
from .licences import GAP


def _tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    body, offsets = raw(text)
    body = lower_ascii(body)
    starts, ends, rows = words(body, offsets, GAP)
    return span_hashes(body, starts, ends), rows


def tiles(i: np.ndarray, j: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed matches (item position, document position): (i, j, length), the longest first."""
    if not len(i):
        return []
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    new = (np.diff(i) != 0) | (np.diff(j) != 0)  # a match that is listed twice counts once
    i, j = i[np.append(True, new)], j[np.append(True, new)]
    runs = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)]))
    sizes = np.diff(np.append(runs, len(i))) + k - 1
    heap = [(-n, a, b) for n, a, b in zip(sizes.tolist(), i[runs].tolist(), j[runs].tolist())]
    heapq.heapify(heap)
    item, doc, out = np.zeros(int(i.max()) + k, bool), np.zeros(int(j.max()) + k, bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = ~(item[a : a - n] | doc[b : b - n])
        if free.all():
            item[a : a - n] = True
            doc[b : b - n] = True
            out.append((a, b, -n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for d, e in zip(edge[::2].tolist(), edge[1::2].tolist()):  # what is left of a match that marked words cut
            if e - d >= k:
                heapq.heappush(heap, (d - e, a + d, b + d))
    return out


def _seeds(rows: DataFrame, id_name: str, least: int, bits: np.ndarray | None = None) -> DataFrame:
    """(id, version, size, seed, at) of every seed: version tells rows of one id apart by their text, size is its number of words."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            whole = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column("text")], ["doc_id", "text"])
            for at_row, text in chunks([whole]):
                h, row = _tokens(text)
                counts = np.bincount(row, minlength=len(text))
                g, at = grams(h, row, least)
                seed, r = g.view(np.int64), row[at]
                place = at - (np.cumsum(counts) - counts)[r]
                if shared.value is not None:
                    on = in_bits(seed, shared.value)
                    seed, r, place = seed[on], r[on], place[on]
                of = at_row.take(pa.array(r))
                yield pa.RecordBatch.from_arrays([batch.column("id").take(of), batch.column("version").take(of), pa.array(counts[r], pa.int64()), pa.array(seed), pa.array(place, pa.int64())], ["id", "version", "size", "seed", "at"])

    named = texts(rows.withColumnRenamed(id_name, "doc_id")) if id_name != "doc_id" else texts(rows)
    return named.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"), "text").mapInArrow(run, "id long, version long, size long, seed long, at long")


def _found(docs: DataFrame, benchmark: DataFrame, threshold: float, least: int) -> DataFrame:
    """doc_id, version (hash of the document's text), item_id, n_tiles, covered, item_words of every contaminated pair of texts."""
    items = _seeds(benchmark.select("item_id", "text"), "item_id", least).select(F.col("id").alias("item_id"), F.col("version").alias("item"), F.col("size").alias("item_words"), "seed", F.col("at").alias("i"))
    mine = _seeds(docs, "doc_id", least, id_bits(items, "seed")).select(F.col("id").alias("doc_id"), "version", "seed", F.col("at").alias("j"))
    pairs = mine.join(items, "seed").groupBy("doc_id", "version", "item_id", "item", "item_words").agg(F.collect_list("i").alias("i"), F.collect_list("j").alias("j"))
    pairs = pairs.where(F.size("i") * least >= F.col("item_words") * threshold)

    def run(batches):
        for batch in batches:
            n, covered = [], []
            for i, j in zip(batch.column("i"), batch.column("j")):
                found = tiles(i.values.to_numpy(), j.values.to_numpy(), least)
                n.append(len(found))
                covered.append(sum(size for _, _, size in found))
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "version", "item_id", "item_words")), pa.array(n, pa.int64()), pa.array(covered, pa.int64())], ["doc_id", "version", "item_id", "item_words", "n_tiles", "covered"])
            yield out.filter(pc.greater_equal(pc.cast(out.column("covered"), pa.float64()), pc.multiply(pc.cast(out.column("item_words"), pa.float64()), threshold)))

    return pairs.mapInArrow(run, "doc_id long, version long, item_id long, item_words long, n_tiles long, covered long")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """doc_id, item_id, n_tiles, covered, item_words and coverage of every contaminated pair."""
    best = _found(docs, benchmark, threshold, least).groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("covered") / F.col("item_words")).alias("coverage"), "n_tiles", "covered", "item_words")).alias("m"))
    return best.select("doc_id", "item_id", "m.n_tiles", "m.covered", "m.item_words", "m.coverage")


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, least: int = 5) -> DataFrame:
    """docs without the contaminated ones; all columns stay. A row goes if its text is contaminated, whatever its doc_id."""
    bad = _found(docs, benchmark, threshold, least).select("version").distinct()
    version = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, version == bad["version"], "left_anti").select(*docs.columns)
