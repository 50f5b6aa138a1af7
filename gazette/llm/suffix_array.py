"""Suffix-array dedup (operator 6): difference-cover blockwise construction for each shard.

Shards hold the different segments of shared anchors (segments.py). Of a shard's suffixes
those at places 1, 2 and 4 modulo 7 are the cover sample; they are ranked first, by doubling,
as deep as a window needs. Then one suffix bucket (by leading bytes) at a time is sorted:
suffixes that agree in 7 bytes are told apart by the sample ranks that both reach within
6 steps. Besides the sample's ranks only one bucket's keys are in memory. Neighbours in the
order that agree in 100 bytes are copies; all but the first by (doc_id, start) go.

Defined cases: null, empty and short texts lose nothing; overlapping copies inside a document
count; matches never cross documents. doc_id is unique, or its rows have equal texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, texts
from .segments import Unit, covered, repeated

WIDTH = 100
V, COVER = 7, (1, 2, 4)
#: For places i and j (modulo V): the smallest step that takes both into the cover.
STEP = np.array([[next(d for d in range(V) if (i + d) % V in COVER and (j + d) % V in COVER) for j in range(V)] for i in range(V)])


def _packed(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    key = np.zeros(len(at), np.uint64)
    for d in range(n):
        key = key << np.uint64(8) | text[at + d].astype(np.uint64)
    return key


def sample_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the cover's suffixes by their first `depth` bytes or more; 0 elsewhere. text ends with depth + V zeros."""
    n = len(text) - depth - V
    at = np.arange(n)
    at = at[np.isin(at % V, COVER)]
    rank = np.zeros(len(text) + depth, np.int64)
    key, known = _packed(text, at, V), V
    while True:
        order = np.argsort(key)
        rank[at[order]] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)]) + 1
        if known >= depth:
            return rank
        key = rank[at].astype(np.uint64) << np.uint64(32) | rank[at + known].astype(np.uint64)
        known *= 2


def ordered(text: np.ndarray, starts: np.ndarray, depth: int, bucket: int = 200_000):
    """Blocks of starts in suffix order (as deep as `depth`), one bucket of leading bytes at a time."""
    rank = sample_ranks(text, depth)
    lead = _packed(text, starts, 3).astype(np.int64)
    by_lead = np.argsort(lead)
    lead = lead[by_lead]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(lead)) + 1, [len(lead)]])
    at = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + bucket, side="right")) - 1)
        part = starts[by_lead[edges[at] : edges[to]]]
        at = to
        key = _packed(text, part, V)
        order = np.argsort(key, kind="stable")
        part, key = part[order], key[order]
        head = np.concatenate([[True], np.diff(key) != 0])
        tied = np.flatnonzero(~head | ~np.append(head[1:], True))  # the others have their place already
        group = np.cumsum(head)[tied] << 32
        tie = part[tied]
        less = np.zeros(len(tie), np.int64)
        classes = [np.flatnonzero(tie % V == c) for c in range(V)]
        ranked: dict[tuple[int, int], np.ndarray] = {}
        for a in range(V):
            for b in range(V):
                if len(classes[a]) and len(classes[b]):
                    step = int(STEP[a, b])
                    if (b, step) not in ranked:
                        ranked[b, step] = np.sort(group[classes[b]] | rank[tie[classes[b]] + step])
                    less[classes[a]] += np.searchsorted(ranked[b, step], group[classes[a]] | rank[tie[classes[a]] + step])
        part[tied] = tie[np.argsort(less)]
        yield part


def search(shard: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows (segments) and window numbers that also stand at an earlier place."""
    pieces = shard.column("body").to_pylist()
    sizes = np.array([len(p) + 1 for p in pieces], np.int64)
    text = np.frombuffer(b"\0".join(pieces) + b"\0" * (2 * WIDTH + 2 * V + 1), np.uint8)
    begins = np.cumsum(sizes) - sizes
    m = shard.column("m").to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(m)), m)
    window = ragged(np.arange(int(m.max(initial=0))), np.zeros(len(m), np.int64), m)[0]
    starts = begins[rows] + window
    doc, place = shard.column("doc_id").to_numpy()[rows], shard.column("at").to_numpy()[rows] + window
    of_start = np.zeros(len(text), np.int64)
    of_start[starts] = np.arange(len(starts))
    later = []
    for block in ordered(text, starts, WIDTH):
        same = np.zeros(len(block), bool)
        for at in range(0, len(block) - 1, 1 << 15):
            a, b = block[at : at + (1 << 15)], block[at + 1 : at + 1 + (1 << 15)]
            near = np.flatnonzero(text[a[: len(b)]] == text[b])
            left, right = a[near], b[near]
            equal = np.ones(len(near), bool)
            for d in range(0, WIDTH, 20):
                go = np.flatnonzero(equal)
                if not len(go):
                    break
                cols = np.arange(d, d + 20)
                equal[go] = (text[left[go][:, None] + cols] == text[right[go][:, None] + cols]).all(1)
            same[at + 1 + near[equal]] = True
        item = of_start[block]
        group = np.cumsum(~same)
        order = np.lexsort((place[item], doc[item], group))
        first = np.concatenate([[True], np.diff(group[order]) != 0]) if len(order) else np.zeros(0, bool)
        later.append(item[order[~first]])
    found = np.concatenate(later) if later else np.zeros(0, np.int64)
    return rows[found], window[found]


def kept_bytes(docs: DataFrame, k: int = 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary, the bytes that stay) and kept_sha256."""
    spans = repeated(docs, Unit(WIDTH, k, False), search, keep_first=True)

    def run(batches):
        for batch in batches:
            out = []
            for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                body = t.encode()
                n, gone, runs = len(body), 0, 0
                if s:
                    mask = covered(s, n)
                    gone = int(mask.sum())
                    runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    body = np.frombuffer(body, np.uint8)[~mask].tobytes()
                out.append((n, gone, runs, body, hashlib.sha256(body).hexdigest()))
            n, gone, runs, kept, digest = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return texts(docs).join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
