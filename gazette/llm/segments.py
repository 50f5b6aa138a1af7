"""Routing for exact search of repeated windows: texts are cut at minimisers, and only what may repeat is gathered.

Each window of `width` tokens (words or bytes) has an anchor, the k-gram in it with the
smallest hash. Equal windows have equal anchors at equal places, so they meet wherever rows
meet by their anchor. A segment is a run of windows of one document with one anchor; every
window belongs to exactly one segment.

1. Segments are counted by anchor (pre-aggregated); those whose anchor stands once can't
   repeat and go no further.
2. Equal segments are one from there on, with their number and their first place.
3. Where an anchor has several different segments, one copy of each goes, with its tokens,
   to a shard chosen by the anchor. A shard's index finds the windows that repeat.
4. An anchor with more than `crowd` different segments doesn't go to one shard: it stands in a
   passage that many documents hold, with different texts around it. There each window is
   counted by a 128-bit hash, pre-aggregated like equal segments, and no body is sent. So no
   shard holds more than its share and `crowd` segments, however common a passage is. (Below
   that an index is cheaper: a segment of bytes is up to 81 windows.)
5. The windows found become intervals of tokens, gathered by document.

No text is compared with all others; what is shuffled are hashes, the different segments of
shared anchors, and each text twice. Rows without a doc_id are compared with nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, drop_written, held, id_bits, in_bits, mix, ragged, raw, released, span_hashes, texts, window_hashes, words, written


#: Tasks of the index stage at most; with more shards, a task takes several, one after the other.
MOST_PARTS = 20_000


@dataclass(frozen=True)
class Unit:
    """What a token is. values: bytes -> (token values, their rows, byte starts, byte ends)."""

    width: int
    k: int
    by_words: bool

    def tokens(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Values, bounds of the rows (n + 1), and for words their bytes' starts and ends."""
        if not self.by_words:
            return body, offsets, np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, ends, rows = words(body, offsets)
        return span_hashes(body, starts, ends), np.searchsorted(rows, np.arange(len(offsets))), starts, ends


def _windows_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w keys, by doubling."""
    n = len(keys) - w + 1
    size = 1
    while size * 2 <= w:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[:n], keys[w - size : w - size + n])


def cut(values: np.ndarray, bounds: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """Segments of all rows: row, first window's start in the row, number of windows, anchor hash, segment hash."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    n, w = len(values), unit.width - unit.k + 1
    if n < unit.width:
        return none
    h = window_hashes(values, unit.k)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(n) - bounds[row]
    low = np.uint64((1 << 30) - 1)
    least = _windows_min(h & ~low | place[: len(h)].astype(np.uint64) & low, w) & low
    valid = np.flatnonzero(row[: n - unit.width + 1] == row[unit.width - 1 :])
    if not len(valid):
        return none
    anchor = least[valid]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(valid) != 1) | (anchor[1:] != anchor[:-1]) | (row[valid[1:]] != row[valid[:-1]])]))
    first = valid[new]
    many = np.diff(np.append(new, len(valid)))
    begin = bounds[row[first]]
    return row[first], first - begin, many, h[begin + anchor[new].astype(np.int64)], span_hashes(values, first, first + many + unit.width - 1)


def _segments(docs: DataFrame, unit: Unit, bits: np.ndarray | None = None) -> DataFrame:
    """All segments; with a bit map of anchors, only those whose anchor may be in it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for ids, text in chunks(batches):
            values, bounds, _, _ = unit.tokens(*raw(text))
            row, first, many, anchor, whole = cut(values, bounds, unit)
            anchor = anchor.view(np.int64)
            if shared.value is not None:
                on = in_bits(anchor, shared.value)
                row, first, many, anchor, whole = row[on], first[on], many[on], anchor[on], whole[on]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array(many.astype(np.int32)), pa.array(anchor), pa.array(whole.view(np.int64))],
                ["doc_id", "at", "m", "anchor", "segment"],
            )

    return docs.mapInArrow(run, "doc_id long, at int, m int, anchor long, segment long")


def _wanted(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """The documents that hold the first places of some segments, with the list of these."""
    lists = kinds.groupBy("doc_id").agg(F.collect_list(F.struct("at", "m", "copies", "anchor")).alias("want"))
    return held(docs, id_bits(lists)).join(lists, "doc_id").select("doc_id", "text", "want")


def _pieces(batches: Iterator[pa.RecordBatch], unit: Unit):
    """Chunk by chunk: the bytes, token values, their bounds and byte places, and the wanted segments as arrays (row in the chunk, doc, at, m, copies, anchor)."""
    for part in batches:
        for at_row, text in chunks([pa.RecordBatch.from_arrays([pa.array(np.arange(part.num_rows)), part.column("text")], ["doc_id", "text"])]):
            body, offsets = raw(text)
            values, bounds, starts, ends = unit.tokens(body, offsets)
            ids = at_row.to_numpy()
            want = part.column("want").slice(int(ids[0]), len(ids))
            flat = want.flatten()
            row = np.repeat(np.arange(len(ids)), pc.list_value_length(want).to_numpy(zero_copy_only=False))
            field = [flat.field(name).to_numpy(zero_copy_only=False) for name in ("at", "m", "copies", "anchor")]
            yield body, values, bounds, starts, ends, row, part.column("doc_id").to_numpy()[ids[row]], *field


def _bodies(docs: DataFrame, kinds: DataFrame, unit: Unit, shards: int) -> DataFrame:
    """The bytes of some segments: shard, doc_id, at, m, copies, body."""

    def run(batches):
        for body, _, bounds, starts, ends, row, doc, at, m, copies, anchor in _pieces(batches, unit):
            first = bounds[row] + at
            last = first + m + unit.width - 1
            if unit.by_words:
                first, last = starts[first], ends[last - 1]
            pieces, edges = ragged(body, first, last - first)
            bodies = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(pieces))])
            shard = mix(anchor.view(np.uint64).copy()) % np.uint64(shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), pa.array(doc), pa.array(at, pa.int32()), pa.array(m, pa.int32()), pa.array(copies, pa.int64()), bodies], ["shard", "doc_id", "at", "m", "copies", "body"])

    return _wanted(docs, kinds).mapInArrow(run, "shard int, doc_id long, at int, m int, copies long, body binary")


def _windows(docs: DataFrame, kinds: DataFrame, unit: Unit) -> DataFrame:
    """Every window of some segments: two hashes, doc_id and at."""

    def run(batches):
        for _, values, bounds, _, _, row, doc, at, m, _, _ in _pieces(batches, unit):
            m = m.astype(np.int64)
            step = ragged(np.arange(int(m.max(initial=0))), np.zeros(len(m), np.int64), m)[0]
            at = np.repeat(at, m) + step
            first = np.repeat(bounds[row], m) + at
            hashes = [span_hashes(v, first, first + unit.width).view(np.int64) for v in (values, mix(values.astype(np.uint64)))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, hashes), pa.array(np.repeat(doc, m)), pa.array(at.astype(np.int32))], ["h1", "h2", "doc_id", "at"])

    return _wanted(docs, kinds).mapInArrow(run, "h1 long, h2 long, doc_id long, at int")


def repeated(docs: DataFrame, unit: Unit, search: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], keep_first: bool, per_shard: int = 4_000, crowd: int = 20_000) -> DataFrame:
    """doc_id and spans, an array of (a, b): the tokens a to b - 1 are covered by windows that repeat.

    keep_first: the first place (by doc_id, then start) of a window isn't reported. search gets a
    shard (doc_id, at, m, copies, body) and returns the row and window number of what it found.
    """
    docs = texts(docs).where(F.col("doc_id").isNotNull())
    later = F.struct("doc_id", "at") != F.struct("first.doc_id", "first.at")
    anchors = written(_segments(docs, unit).groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "anchors")
    shared = written(_segments(docs, unit, id_bits(anchors, "anchor")).join(anchors, "anchor"), "shared")
    released(docs.sparkSession)
    kinds = shared.groupBy("anchor", "segment").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "at")).alias("first"), F.first("m").alias("m"))
    kinds = written(kinds, "kinds")
    many = kinds.where("copies > 1").select("anchor", "segment", "first")
    whole = shared.join(many, ["anchor", "segment"])
    if keep_first:
        whole = whole.where(later)
    whole = whole.select("doc_id", F.col("at").alias("a"), (F.col("at") + F.col("m") + unit.width - 1).alias("b"))

    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = kinds.join(several, "anchor").select("first.doc_id", "first.at", "m", "copies", "anchor", (F.col("kinds") > crowd).alias("crowded"))
    wanted = written(wanted, "wanted")
    counts = wanted.groupBy("crowded").count().collect()
    number = {r["crowded"]: r["count"] for r in counts}
    shards = max(1, -(-number.get(False, 0) // per_shard))

    def index(shard: pa.Table) -> pa.Table:
        row, window = search(shard)
        order = np.lexsort((window, row))
        row, window = row[order], window[order]
        start = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(window) != 1)])) if len(row) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(start, len(row)))
        a = shard.column("at").to_numpy()[row[start]] + window[start]
        return pa.table({"doc_id": shard.column("doc_id").to_numpy()[row[start]], "a": a.astype(np.int32), "b": (a + sizes + unit.width - 1).astype(np.int32)})

    bodies = _bodies(docs, wanted.where("NOT crowded"), unit, shards)
    parts = min(shards, MOST_PARTS)  # shards are dealt out by number, so none of two meet by chance while another task has none
    dealt = bodies.withColumn("part", F.col("shard") % parts).repartitionById(parts, F.col("part")).groupBy("part", "shard")
    inside = written(dealt.applyInArrow(index, "doc_id long, a int, b int"), "inside")
    released(docs.sparkSession)
    found = whole.unionByName(inside)
    windows = None
    if number.get(True):
        windows = written(_windows(docs, wanted.where("crowded"), unit), "windows")
        often = windows.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "at")).alias("first")).where("c > 1").drop("c")
        places = windows.join(often, ["h1", "h2"])
        if keep_first:
            places = places.where(later)
        found = found.unionByName(places.select("doc_id", F.col("at").alias("a"), (F.col("at") + unit.width).alias("b")))
    spans = written(found.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    for t in (anchors, shared, kinds, wanted, inside, *([windows] if windows is not None else [])):
        drop_written(t)
    released(docs.sparkSession)
    return spans


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """Which of n tokens the spans cover."""
    step = np.zeros(n + 1, np.int64)
    for s in spans or ():
        step[s["a"]] += 1
        step[min(s["b"], n)] -= 1
    return np.cumsum(step[:n]) > 0
