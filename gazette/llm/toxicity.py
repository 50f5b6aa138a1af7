"""Toxicity (operator 4): a noisy channel is undone, and the restored text is scored.

1. A character model: counts of four letters in a row, over all documents.
2. Words that look disguised (signs or digits among letters, letters drawn out, single letters
   in a row) become lattices: each sign may stand for itself, for the letters that it imitates,
   for a word boundary or for nothing. Viterbi search under the character model finds the one
   best path, which takes the word's place in the text. The model knows nothing of toxic words.
3. A bounded sample of labelled rows gives the words and stems that mark toxic texts (document
   frequencies by label, over restored texts) and a logistic model of their weights.
4. Every whole text is restored, and the restored text is scored by its marked words.

Defined cases: null and empty texts get the score of a text without any marked word; with
no labelled rows the score is the prior 0.5 below `threshold` (0.25); disguised words have any
length; repeated rows are scored each for itself, repeated label rows count once per row; a row
without a doc_id is scored, and held_out is false for it; labels that are null aren't learnt from.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, in_training, lower_ascii, raw, span_hashes, texts, words

#: Letters that a sign is used for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
FILLERS = "*._-~'`^#"
#: Letters and the word boundary (0) that the character model tells apart, and how many of them in a row.
SYMBOLS, ORDER = 27, 4

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[0x80:] = True
_NOT_LETTER = ~_LETTER
_SIGN = np.zeros(256, bool)
_SIGN[list(b"0123456789@$!|+(" + FILLERS.encode())] = True
_STRONG = np.zeros(256, bool)
_STRONG[list(b"0123456789@$")] = True
#: Signs that stand for letters at a word's ends, too; 0xC3 to 0xC5 lead the accented letters, 0xC2A3 and 0xE282AC are money signs.
_END = np.zeros(256, bool)
_END[list(b"!|+(")] = True
#: What may stand around a word without being a part of it.
_AROUND = ".,;:!?\"'()[]*#&%$-_~`^"
_SOFT = "".join(c for c in _AROUND if c not in LEET)
#: A mark between letters that stood alone in the text.
_GAP = "\x01"


class Channel:
    """Log-probabilities of four symbols in a row (0: word boundary), given the first three."""

    def __init__(self, counts: np.ndarray):
        """Each order leans on the one below it, so that four letters that never stood together aren't impossible."""
        share = np.full(SYMBOLS, 1 / SYMBOLS)
        for n in range(1, ORDER + 1):
            c = counts.sum(tuple(range(ORDER - n))) if n < ORDER else counts
            share = (c + 4 * share) / (c.sum(-1, keepdims=True) + 4)
        self.table = np.log(share)
        self.log = self.table.ravel().tolist()
        # in a run of stars each symbol read costs 0.8 or more beyond reading nothing, and four lead to any state
        self.longest = int(4 * (2 - self.table.min()) / 0.8) + 2


def _base(c: str) -> str:
    """The letter under an accent; other signs as they are."""
    base = c if c < "\x80" else unicodedata.normalize("NFKD", c)[:1].lower()
    return base if "a" <= base <= "z" else c


def emissions(token: str) -> list[list[tuple[int, float]]]:
    """For each sign of the token: what may have been meant (1 to 26: letters, 0: boundary, -1: nothing), with the channel's log-probability."""
    out = []
    for i, c in enumerate(token):
        same = i and c == token[i - 1]
        may = [(-1, -0.2 if token[i - 2 : i] == 2 * c or token[i + 1 : i + 2] == c else -2.0)] if same else []  # three alike are drawn out, two may be meant
        base = _base(c)
        if "a" <= base <= "z":
            may.append((ord(base) - 96, -0.05 if c == base else -0.1))
        for x in LEET.get(c, ""):
            may.append((ord(x) - 96, -0.5))
        if c == "*":  # hides any letter
            may += [(x, -2.0) for x in range(1, SYMBOLS)]
        if c == _GAP or c in FILLERS:
            may += [(-1, -0.2), (0, -1.0)]
        elif c in LEET:
            may += [(-1, -3.0), (0, -3.0)]
        out.append(may or [(0, -0.1), (-1, -3.0)])
    return out


def decode(token: str, channel: Channel) -> str:
    """The best path through the token's lattice: words of small letters, one space between. Viterbi over the last three symbols."""
    if "*" in token:
        return _decode_dense(re.sub(r"\*{%d,}" % channel.longest, "*" * channel.longest, token), channel.table)
    log, keep = channel.log, SYMBOLS ** (ORDER - 1)
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}  # last symbols -> score, what was read
    for may in emissions(token):
        new: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, read) in states.items():
            for symbol, cost in may:
                if symbol < 0 or symbol == 0 and state % SYMBOLS == 0:
                    key, s, then = state, score + cost, read
                else:
                    at = state * SYMBOLS + symbol
                    key, s, then = at % keep, score + cost + log[at], (symbol, read)
                    if not symbol:
                        key = 0
                if key not in new or s > new[key][0]:
                    new[key] = (s, then)
        states = new
    ended = [(s + (log[state * SYMBOLS] if state else 0.0), state) for state, (s, _) in states.items()]
    read, out = states[max(ended)[1]][1], []
    while read:
        out.append(chr(read[0] + 96) if read[0] else " ")
        read = read[1]
    return "".join(reversed(out)).strip()


def _decode_dense(token: str, table: np.ndarray) -> str:
    """The same for tokens with stars, which stand for any letter: all 27^3 states as an array, a step at a time.

    A star reads nothing more cheaply than a letter, so of a long run only so many stars matter as
    could pay for the way to any state; decode() cuts it to that, and the best reading stays the same.
    """
    shape = table.shape[:-1]
    score = np.full(shape, -np.inf)
    score[0, 0, 0] = 0.0
    back: list[tuple[np.ndarray, np.ndarray]] = []
    number = np.arange(score.size).reshape(shape)
    ended = number % SYMBOLS == 0
    for may in emissions(token):
        best, come, read = np.full(score.size, -np.inf), number.ravel().copy(), np.full(score.size, -1, np.int8)

        def offer(at: np.ndarray, value: np.ndarray, origin: np.ndarray, symbol: int) -> None:
            better = value > best[at]
            at = at[better]
            best[at], come[at], read[at] = value[better], origin[better], symbol

        for symbol, cost in may:
            if symbol < 0:
                offer(number.ravel(), (score + cost).ravel(), number.ravel(), -1)
            elif symbol == 0:
                offer(number[ended], score[ended] + cost, number[ended], -1)
                told = np.where(ended, -np.inf, score + cost + table[..., 0]).ravel()
                k = int(told.argmax())
                offer(np.zeros(1, np.int64), told[k : k + 1], np.array([k]), 0)
            else:
                told = score + cost + table[..., symbol]
                first = told.argmax(axis=0)
                rest = number[0]  # the last two symbols
                offer((rest * SYMBOLS + symbol).ravel(), np.take_along_axis(told, first[None], 0).ravel(), (first * SYMBOLS**2 + rest).ravel(), symbol)
        back.append((come, read))
        score = best.reshape(shape)
    final = (score + np.where(number == 0, 0.0, table[..., 0])).ravel()
    state, out = len(final) - 1 - int(final[::-1].argmax()), []
    for come, read in reversed(back):
        if read[state] >= 0:
            out.append(chr(read[state] + 96) if read[state] else " ")
        state = int(come[state])
    return "".join(reversed(out)).strip()


def _disguised(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words hold signs among letters, a digit or money sign beside a letter, or three equal letters."""
    letter, sign = _LETTER[body], _SIGN[body]
    before, after = np.zeros(len(body), bool), np.zeros(len(body), bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    odd = sign & before & after | _STRONG[body] & after
    odd[:-1] |= (_STRONG[body] & before & (body != 36))[:-1]
    solid = np.flatnonzero(~sign)  # a run of signs between two letters
    odd[solid[1:][(np.diff(solid) > 1) & letter[solid[:-1]] & letter[solid[1:]]]] = True
    odd |= _END[body] & (before | after)
    odd[:-1] |= (body[:-1] >= 0xC3) & (body[:-1] <= 0xC5) | (body[:-1] == 0xC2) & (body[1:] == 0xA3)
    odd[:-2] |= (body[:-2] == 0xE2) & (body[1:-1] == 0x82) & (body[2:] == 0xAC)
    same = np.zeros(len(body), bool)
    same[2:] = (body[2:] == body[1:-1]) & (body[1:-1] == body[:-2]) & letter[2:]
    seen = np.concatenate([[0], np.cumsum(odd | same)])
    return seen[ends] > seen[starts]


def _read(token: str, decoder) -> str:
    """A disguised word as the channel reads it; plain signs around it stay off unless they can be letters of it."""
    inner = token.strip(_AROUND)
    if inner.isascii() and inner.isalpha() and not re.search(r"(.)\1\1", inner):
        soft = token.strip(_SOFT)
        return decoder(soft) if soft != inner and len(soft) > 2 else inner
    return decoder(token.strip(_SOFT) or inner)


def restored(text: pa.Array, decoder) -> pa.Array:
    """The texts in small letters, with each disguised word in its best reading. Runs of three single letters or more are one word."""
    body, offsets = raw(text)
    body = lower_ascii(body)
    starts, ends, rows = words(body, offsets)
    if not len(starts):
        return text
    single = (ends - starts == 1) & (_LETTER[body[starts]] | _STRONG[body[starts]])
    run = np.cumsum(np.concatenate([[True], ~(single[1:] & single[:-1]) | (np.diff(rows) != 0)]))
    spaced = single & (np.bincount(run)[run] >= 3)
    data, edits = body.tobytes(), []
    for i in np.flatnonzero(_disguised(body, starts, ends) & ~spaced).tolist():
        edits.append((int(starts[i]), int(ends[i]), _read(data[starts[i] : ends[i]].decode("utf-8", "ignore"), decoder)))
    at = np.flatnonzero(spaced)
    for part in np.split(at, np.flatnonzero(np.diff(run[at])) + 1) if len(at) else ():
        edits.append((int(starts[part[0]]), int(ends[part[-1]]), decoder(_GAP.join(map(chr, body[starts[part]].tolist())))))
    edits.sort()
    out, place, bounds, k = [], 0, [0], 0
    size = 0
    for stop in offsets[1:].tolist():
        while k < len(edits) and edits[k][0] < stop:
            first, last, said = edits[k]
            k += 1
            new = said.encode()
            out += [data[place:first], new]
            size += first - place + len(new)
            place = last
        out.append(data[place:stop])
        size += stop - place
        place = stop
        bounds.append(size)
    return pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer(np.array(bounds, np.int64)), pa.py_buffer(b"".join(out))])


def letter_counts(docs: DataFrame) -> np.ndarray:
    """How often four symbols stand in a row in all documents: 27^4 numbers, whatever the corpus."""
    cells = SYMBOLS**ORDER

    def run(batches):
        total = np.zeros(cells, np.int64)
        for _, text in chunks(batches):
            body, offsets = raw(text)
            body = lower_ascii(body)
            s = np.where((body >= 97) & (body <= 122), body - 96, 0).astype(np.int64)
            s = s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])] if len(s) else s  # one boundary between words
            starts = np.flatnonzero((s > 0) & np.concatenate([[True], s[:-1] == 0])) if len(s) else np.zeros(0, np.int64)
            pad = np.zeros(len(s) + 2 * len(starts) + 1, np.int64)  # three boundaries before each word, one after it
            pad[np.arange(len(s)) + 2 * np.searchsorted(starts, np.arange(len(s)), side="right") + (0 if len(s) and s[0] == 0 else 1)] = s
            pad = np.concatenate([[0, 0, 0], pad, [0]])
            code = ((pad[:-3] * SYMBOLS + pad[1:-2]) * SYMBOLS + pad[2:-1]) * SYMBOLS + pad[3:]
            total += np.bincount(code[(pad[3:] > 0) | (pad[2:-1] > 0)], minlength=cells)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k])], ["code", "n"])

    found = texts(docs).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells)
    out[found["code"].to_numpy()] = found["n"].to_numpy()
    return out.reshape((SYMBOLS,) * ORDER)


@dataclass
class Model:
    channel: Channel
    weights: dict[str, float]
    coefficients: np.ndarray


#: Lengths of the stems (beginnings of longer words) that may be marked beside whole words; the longest that is marked tells.
STEMS = (8, 7, 6, 5, 4)


class Scorer:
    """Made once in each task: hits of marked words and stems in restored text."""

    def __init__(self, model: Model):
        self.tables: list[tuple[int, np.ndarray, np.ndarray]] = []  # stem length (0: whole words), their hashes, their places in values
        self.values = np.array([w for _, w in sorted(model.weights.items())])
        for k in (0, *STEMS):
            mine = [(i, n.rstrip("*")) for i, n in enumerate(sorted(model.weights)) if (len(n) == k + 1 and n.endswith("*") if k else not n.endswith("*"))]
            if mine:
                flat = np.frombuffer("".join(n for _, n in mine).encode(), np.uint8)
                ends = np.cumsum([len(n.encode()) for _, n in mine]).astype(np.int64)
                h = span_hashes(flat, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)
                order = np.argsort(h)
                self.tables.append((k, h[order], np.array([i for i, _ in mine])[order]))
        self.decoder = lru_cache(100_000)(lambda t: decode(t, model.channel))

    def features(self, text: pa.Array) -> np.ndarray:
        """Per text: summed weight of distinct marked words and stems, largest weight, number of hits (log), hits per word (log)."""
        n = len(text)
        x = np.zeros((n, 4))
        if not self.tables:
            return x
        body, offsets = raw(restored(text, self.decoder))
        body = lower_ascii(body)
        starts, ends, rows = words(body, offsets, _NOT_LETTER)
        mark = np.full(len(starts), -1)
        for k, known, place in self.tables:
            may = np.flatnonzero((mark < 0) & (ends - starts > k))
            h = span_hashes(body, starts[may], starts[may] + k if k else ends[may])
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            mark[may[hit]] = place[at[hit]]
        row, kind = rows[mark >= 0], mark[mark >= 0]
        hits, count = np.bincount(row, minlength=n), np.bincount(rows, minlength=n)
        once = np.unique(row * len(self.values) + kind)
        row, value = once // len(self.values), self.values[once % len(self.values)]
        x[:, 0] = np.bincount(row, value, minlength=n)
        np.maximum.at(x[:, 1], row, value)
        x[:, 2], x[:, 3] = np.log1p(hits), np.log1p(100 * hits / np.maximum(1, count))
        return x


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w + np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
    return w


def _marked(rows: DataFrame, channel: Channel, least_docs: int) -> dict[str, float]:
    """Words and stems of restored texts that tell toxic rows apart: log-odds for those far beyond chance.

    z, the distance from chance in standard deviations, must be more than 6 and at least a quarter of
    the best word's: beside words that many toxic rows hold, those of a few copies of one are noise.
    """

    def run(batches):
        decoder = lru_cache(100_000)(lambda t: decode(t, channel))
        for batch in batches:
            for t, y in zip(restored(batch.column("text"), decoder).to_pylist(), batch.column("y").to_pylist()):
                seen = set(re.findall(r"[^\W\d_]{2,}", t))
                seen = sorted(seen | {w[:k] + "*" for w in seen for k in STEMS if len(w) > k})
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), pa.array([y] * len(seen), pa.int32())], ["word", "y"])

    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not toxic or toxic == n:
        return {}
    share = toxic / n
    a, all_ = F.col("a"), F.col("all")
    odds = F.log((a + 0.5) / F.lit(float(toxic) + 1)) - F.log((all_ - a + 0.5) / F.lit(float(n - toxic) + 1))
    z = (a - all_ * share) / F.sqrt(all_ * share * (1 - share))
    counts = rows.select("text", "y").mapInArrow(run, "word string, y int").groupBy("word").agg(F.sum("y").alias("a"), F.count("*").alias("all"))
    best = counts.where((a >= least_docs) & (odds > 1.5) & (z > 6)).select("word", odds.alias("w"), z.alias("z")).toArrow().to_pylist()
    least = max((r["z"] for r in best), default=0.0) / 4
    return {r["word"]: float(r["w"]) for r in best if r["z"] >= least}


def trained(docs: DataFrame, labels: DataFrame, column: str = "toxic", max_rows: int = 20_000, least_docs: int = 5) -> Model:
    """The sample of labelled rows is bounded by a parameter; the character model is of all documents."""
    channel = Channel(letter_counts(docs))
    some = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[column].cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & in_training(F.col("doc_id")))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows)
    rows = texts(docs).join(F.broadcast(some), "doc_id").persist()
    weights = _marked(rows, channel, least_docs)
    model = Model(channel, weights, np.array([-math.log(3), 0, 0, 0, 0]))

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            x = scorer.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 4).cast(pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    sample = rows.select("text", "y").mapInArrow(run, "x array<double>, y int").collect()
    sample.sort(key=lambda r: (r["x"], r["y"]))
    rows.unpersist()
    if sample:
        model.coefficients = _logistic(np.array([r["x"] for r in sample]), np.array([r["y"] for r in sample], float))
    return model


def scored(docs: DataFrame, labels: DataFrame, column: str = "toxic", threshold: float = 0.5, max_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = trained(docs, labels, column, max_rows)

    def run(batches):
        scorer = Scorer(model)
        for ids, text in chunks(batches):
            z = model.coefficients[0] + scorer.features(text) @ model.coefficients[1:]
            yield pa.RecordBatch.from_arrays([ids, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    out = texts(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(~in_training(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
