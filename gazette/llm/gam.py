"""Quality classifier (operator 2): a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after the other, fits a shallow tree to the gradient and
adds it to that feature's lookup table; then the strongest pairs of features get tables in
the same way. Scoring is one bin search per feature and a sum of looked-up values, on whole
Arrow batches.

The model is fitted on a bounded sample of the labelled rows that may be learnt from
(`max_rows`, the rows with the smallest hash of doc_id); a sample row carries some floats.

Defined cases: null and empty texts are scored like any text (all counts 0); with no
labelled rows every score is 0.5; labels that are null aren't learnt from; repeated label
rows count once per row; ties don't depend on the order of rows; a row without a doc_id is scored,
and held_out is false for it; other columns go (kept() keeps them all).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, grams, in_training, mix, raw, span_hashes, texts, words

FEATURES = ("log_words", "mean_word", "symbols", "capitals", "digits", "shouts", "pipes", "full_stops", "commas", "repeated_lines", "repeated_grams", "distinct_words", "words_per_line", "short_words")

_SYMBOL, _CAPITAL, _SMALL, _DIGIT, _SHOUT, _PIPE, _STOP, _COMMA, _OTHER = range(9)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[list(b"#*$%&<>")] = _SYMBOL
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _CAPITAL, _SMALL, _DIGIT
_CLASS[ord("!")], _CLASS[ord("|")], _CLASS[ord(".")], _CLASS[ord(",")] = _SHOUT, _PIPE, _STOP, _COMMA


def _repeats(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many values there are, and how many distinct ones."""
    _, first = np.unique(mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1))), return_index=True)
    return np.bincount(rows, minlength=n), np.bincount(rows[first], minlength=n)


def features(text: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    body, offsets = raw(text)
    n, sizes = len(text), np.diff(offsets)
    kinds = np.bincount(np.repeat(np.arange(n), sizes) * 9 + _CLASS[body], minlength=n * 9).reshape(n, 9)
    starts, ends, rows = words(body, offsets)
    h = span_hashes(body, starts, ends)
    count = np.bincount(rows, minlength=n)
    some = np.maximum(count, 1)
    length = np.bincount(rows, ends - starts, minlength=n)
    g, at = grams(h, rows, 5)
    all_grams, own_grams = _repeats(g, rows[at], n)
    _, own_words = _repeats(h, rows, n)
    breaks = np.zeros(256, bool)
    breaks[10] = True
    ls, le, lr = words(body, offsets, breaks)
    lines, own_lines = _repeats(span_hashes(body, ls, le), lr, n)
    letters = np.maximum(kinds[:, _CAPITAL] + kinds[:, _SMALL], 1)
    chars = np.maximum(sizes, 1)
    return np.stack(
        [
            np.log1p(count), length / some, kinds[:, _SYMBOL] / chars, kinds[:, _CAPITAL] / letters, kinds[:, _DIGIT] / chars, kinds[:, _SHOUT] / some, kinds[:, _PIPE] / some, kinds[:, _STOP] / some, kinds[:, _COMMA] / some,
            1 - own_lines / np.maximum(lines, 1), 1 - own_grams / np.maximum(all_grams, 1), own_words / some, count / np.maximum(lines, 1), np.bincount(rows, ends - starts <= 3, minlength=n) / some,
        ],
        axis=1,
    )


@dataclass
class Gam:
    """Bin edges and lookup tables; the score's log-odds are their sum."""

    edges: list[np.ndarray]
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for i, j, t in self.pairs:
            z += t[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """The step of a shallow tree over ordered bins: gradient sums g and curvature sums h in, a value per bin out."""
    cuts = [0, len(g)]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + ridge)
    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = worth(a, k) + worth(k, b) - worth(a, b)
                if gain.max() > best:
                    best, where = gain.max(), int(k[gain.argmax()])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + ridge)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, pairs: int = 6, pair_rounds: int = 40, rate: float = 0.1, leaves: int = 4, ridge: float = 4.0) -> Gam:
    """Cyclic boosting on a sample that fits in memory; rows in any order give the same model."""
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model = Gam([np.unique(np.quantile(x[:, j], quantiles)) if len(x) else np.zeros(0) for j in range(x.shape[1])])
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    if not len(x):
        return model
    b, p = model.bins(x), np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(p / (1 - p)))
    z = np.full(len(x), model.base)
    for _ in range(rounds):
        for j, s in enumerate(sizes):
            q = 1 / (1 + np.exp(-z))
            step = rate * _tree(np.bincount(b[:, j], y - q, s), np.bincount(b[:, j], q * (1 - q), s), leaves, ridge)
            model.tables[j] += step
            z += step[b[:, j]]
    grid = lambda i, j, v: np.bincount(b[:, i] * sizes[j] + b[:, j], v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    def quadrants(i: int, j: int) -> tuple[float, np.ndarray]:
        """The best pair of cuts, one on each feature, and its four values."""
        q = 1 / (1 + np.exp(-z))
        g, h = grid(i, j, y - q), grid(i, j, q * (1 - q))
        cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
        u, v = np.arange(1, sizes[i])[:, None], np.arange(1, sizes[j])[None, :]
        if not u.size or not v.size:
            return 0.0, np.zeros_like(g)
        corner = lambda c: (c[u, v], c[u, -1] - c[u, v], c[-1, v] - c[u, v], c[-1, -1] - c[u, -1] - c[-1, v] + c[u, v])
        parts = list(zip(corner(cg), corner(ch)))
        gain = sum(a * a / (c + ridge) for a, c in parts)
        m, k = np.unravel_index(int(gain.argmax()), gain.shape)
        values = [a[m, k] / (c[m, k] + ridge) for a, c in parts]
        out = np.empty_like(g)
        out[: m + 1, : k + 1], out[: m + 1, k + 1 :], out[m + 1 :, : k + 1], out[m + 1 :, k + 1 :] = values
        return float(gain.max()), out

    found = sorted(((quadrants(i, j)[0], i, j) for i in range(len(sizes)) for j in range(i)), reverse=True)[:pairs]
    model.pairs = [(i, j, np.zeros((sizes[i], sizes[j]))) for _, i, j in found]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            step = rate * quadrants(i, j)[1]
            t += step
            z += step[b[:, i], b[:, j]]
    return model


def featured(docs: DataFrame) -> DataFrame:
    def run(batches):
        for ids, text in chunks(batches):
            x = features(text)
            yield pa.RecordBatch.from_arrays([ids, pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "x"])

    return texts(docs).mapInArrow(run, "doc_id long, x array<double>")


def trained(docs: DataFrame, labels: DataFrame, column: str, max_rows: int) -> Gam:
    """Fit on at most max_rows labelled rows: the sample is bounded, so it may be broadcast and sent to the driver."""
    some = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[column].cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows)
    rows = featured(texts(docs).join(F.broadcast(some), "doc_id", "left_semi")).join(F.broadcast(some), "doc_id").orderBy("doc_id", "x", "y").collect()
    return fit(np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r["y"] for r in rows], float))


def scored(docs: DataFrame, labels: DataFrame, column: str = "quality", threshold: float = 0.3, max_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = trained(docs, labels, column, max_rows)

    def run(batches):
        for ids, text in chunks(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array(model.score(features(text)))], ["doc_id", "score"])

    out = texts(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, column: str = "quality", threshold: float = 0.3, max_rows: int = 20_000) -> DataFrame:
    """The rows of docs that the classifier doesn't reject; all columns stay, nothing is shuffled."""
    model = trained(docs, labels, column, max_rows)

    def run(batches):
        for batch in batches:
            text = pc.fill_null(batch.column("text").cast(pa.string()), "")
            ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
                good = model.score(features(text.slice(at, to - at))) >= threshold
                yield batch.slice(at, to - at).filter(pa.array(good))
                at = to

    return docs.mapInArrow(run, docs.schema)
