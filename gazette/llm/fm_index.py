"""Substring dedup (operator 3): a compressed FM-index for each shard.

Shards hold the different segments of shared anchors (segments.py). A shard's index is the
Burrows-Wheeler transform of its words, as a wavelet matrix of packed bits with rank counts.
Segments are streamed against it by backward search, many side by side: a search goes left
word by word while what it has matched stands at least twice (copies count). The lengths
reached are the matching statistics; windows of 35 words or more inside them are reported.

Defined cases: null, empty and short texts lose nothing; a window that stands twice in one
document is repeated; windows never cross documents; a document that stands twice loses
every word if it has 35 or more. doc_id is unique, or its rows have equal texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, raw, span_hashes, texts, words
from .segments import Unit, covered, repeated

WIDTH = 35


class Bits:
    """A bit vector in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + b"\0" * (16 - len(packed) % 8), np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)
        self.zeros = int(len(bits) - self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many ones stand before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask).astype(np.int64)


class FmIndex:
    """Backward search over sequences of symbols 1, 2, ...; sequences are kept apart by separators."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, weights: np.ndarray):
        """symbols of all sequences, bounds (n + 1), and how often each sequence counts."""
        n = len(bounds) - 1
        sizes = np.diff(bounds)
        text = np.zeros(len(symbols) + n, np.int64)
        owner = np.repeat(np.arange(n), sizes + 1)
        place = np.arange(len(symbols)) + np.repeat(np.arange(n), sizes)
        text[place] = symbols + n  # separators are all different, so no comparison goes beyond one
        text[bounds[1:] + np.arange(n)] = np.arange(n)
        order = self._sorted(text)
        last = text[order - 1]
        last = np.where(last >= n, last - n, 0)
        self.levels = max(1, int(symbols.max(initial=1)).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(np.where(text >= n, text - n, 0), minlength=(1 << self.levels) + 1))])
        self.counted = np.concatenate([[0], np.cumsum(weights[owner[order]])])
        self.matrix: list[Bits] = []
        for level in range(self.levels - 1, -1, -1):
            bit = (last >> level & 1).astype(bool)
            self.matrix.append(Bits(bit))
            last = np.concatenate([last[~bit], last[bit]])
        self.size = len(text)
        self.base = self._descend(np.zeros(1 << self.levels, np.int64), np.arange(1 << self.levels))

    @staticmethod
    def _sorted(text: np.ndarray) -> np.ndarray:
        """Suffix order by prefix doubling; the separators end it after a few rounds."""
        n = len(text)
        rank, step = text.copy(), 1
        while True:
            nxt = np.zeros(n, np.int64)
            nxt[: n - step] = rank[step:] + 1
            key = rank << 32 | nxt
            order = np.argsort(key)
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank[order] = new
            if new[-1] == n - 1:
                return order
            step *= 2

    def _descend(self, i: np.ndarray, c: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.levels - 1, -1, -1), self.matrix):
            ones = bits.ones(i)
            i = np.where(c >> level & 1, bits.zeros + ones, i - ones)
        return i

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of c + pattern from those of the patterns."""
        both = self._descend(np.concatenate([lo, hi]), np.concatenate([c, c])) - np.concatenate([self.base[c], self.base[c]])
        return self.first[c] + both[: len(c)], self.first[c] + both[len(c) :]

    def matched(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = 2) -> np.ndarray:
        """For each symbols[start:end]: the smallest s so that symbols[s:end] counts `least` times or more."""
        reach = ends.copy()
        live = np.flatnonzero(ends > starts)
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64)
        while len(live):
            lo, hi = self.extend(lo, hi, symbols[reach[live] - 1])
            good = self.counted[hi] - self.counted[lo] >= least
            live, lo, hi = live[good], lo[good], hi[good]
            reach[live] -= 1
            on = reach[live] > starts[live]
            live, lo, hi = live[on], lo[on], hi[on]
        return reach


def search(shard: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows (segments) and window numbers that stand at least twice."""
    body, offsets = raw(shard.column("body").combine_chunks().cast(pa.string()))
    starts, ends, rows = words(body, offsets)
    _, symbols = np.unique(span_hashes(body, starts, ends), return_inverse=True)
    symbols = symbols.astype(np.int64) + 1
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    copies, m = shard.column("copies").to_numpy(), shard.column("m").to_numpy().astype(np.int64)
    index = FmIndex(symbols, bounds, copies)
    single = np.flatnonzero(copies == 1)  # the others repeat as a whole, which the caller knows
    first, last = bounds[single], bounds[single + 1]
    reach = index.matched(symbols, first, last) - first
    row, window = ragged(np.arange(int(m.max(initial=0))), np.minimum(reach, m[single]), m[single] - np.minimum(reach, m[single]))[0], None
    row, window = np.repeat(single, m[single] - np.minimum(reach, m[single])), row
    out_row, out_window = [row], [window]
    # what lies left of the place where the whole segment stopped: each of those windows on its own
    left = np.minimum(reach, m[single])
    each_row, each = np.repeat(single, left), ragged(np.arange(int(m.max(initial=0))), np.zeros(len(left), np.int64), left)[0]
    for at in range(0, len(each), 1 << 18):
        r, k = each_row[at : at + (1 << 18)], each[at : at + (1 << 18)]
        begin = bounds[r] + k
        whole = index.matched(symbols, begin, begin + WIDTH) == begin
        out_row.append(r[whole])
        out_window.append(k[whole])
    return np.concatenate(out_row), np.concatenate(out_window)


def kept_words(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the text of the words that stay) and kept_sha256."""
    spans = repeated(docs, Unit(WIDTH, k, True), search, keep_first=False)

    def run(batches):
        for batch in batches:
            out = []
            for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                every = t.encode().split()
                if s:
                    gone = covered(s, len(every))
                    kept = [w for w, g in zip(every, gone.tolist()) if not g]
                else:
                    kept = every
                body = b" ".join(kept)
                out.append((len(every), len(every) - len(kept), body.decode(), hashlib.sha256(body).hexdigest()))
            n, gone, kept, digest = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return texts(docs).join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
