"""Phrase collocations by weighted acyclic automata.

Texts are cut into pieces at punctuation and pieces into words; all counts are per language. Each
shard of texts sorts its phrases and builds a count transducer of them: an acyclic automaton whose
arcs are words and carry the count of the phrase that they end. States with the same few arcs are
one state, and all phrases end in one final state. A shard's transducer is dealt out by prefix
range, the hash of a phrase's first words. The transducers of a range are united by summing
weights, a few at a time, and only phrases that are frequent enough stay; a part of a phrase is
at least as frequent as the phrase, so nothing that matters is lost. Words and pairs are counted
first; longer phrases are counted only where each of their pairs may be frequent.

Parts are looked up by composition: each range asks every other one for the parts that its phrases
need by an acceptor whose arcs carry places; composed with the range's transducer it gives counts
by place. A part that very many phrases share is asked for once by each range, so no key is hot.

Words are compared as text. Hashes only choose ranges and thin out what can't be frequent; the map
of frequent pairs is sized by their number, up to 32 MB, beyond which it thins out less.

Defined results: null, empty and wordless texts have no phrases. A null lang is und, and so is one
named so. Rows that repeat count each time, whatever their doc_id, null included; columns other
than text and lang don't matter. Equal scores rank by count, then by the phrase's bytes. A text
that is longer than a shard is cut between pieces. Tables without frequent phrases give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_BYTES, BATCH_DEFAULT, BATCH_SETTING, bits_for, drop_written, id_bits, in_bits, lower_ascii, mix, ragged, raw, span_hashes, words, written

LONGEST = 4
#: Bytes of text of which a shard makes one transducer.
SHARD_BYTES = 3 << 20
#: Phrases that a union holds unsummed at most.
PENDING = 1 << 19
#: Scores are in parts of this number.
SCALE = 2_000_000
#: An automaton's row. words: its labels' texts; degree: arcs of each state, the last state is the root, state 0 the final one; label, weight, target: of each arc, by state and label.
AUTOMATON = "words array<string>, degree array<int>, label array<int>, weight array<bigint>, target array<int>"
CELL = "lang string, range int"

_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[0x0A:0x0E] = True
_GAP[[0x20, 0x09]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


# automata


def automata(cell: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The transducers of all cells at once: cells in order, and of each arc (place of the cell, state, word number, weight, target).

    grams: a row of word numbers per phrase, padded with -1; counts of equal phrases are summed up.
    """
    base = np.int64(grams.max() + 1)
    node, parents, labels, weights, alive = cell.astype(np.int64), [], [], [], np.arange(len(cell))
    cells, node = np.unique(node, return_inverse=True)
    sizes = [len(cells)]
    length = (grams >= 0).sum(axis=1)
    for d in range(grams.shape[1]):
        deeper = length[alive] > d
        alive, node = alive[deeper], node[deeper]
        if not len(alive):
            break
        keys, node = np.unique(node * base + grams[alive, d], return_inverse=True)
        parents.append(keys // base)
        labels.append(keys % base)
        here = length[alive] == d + 1
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, node[here], counts[alive[here]])
        weights.append(total)
        sizes.append(len(keys))
    root = np.arange(len(cells))
    owner = [root]  # the cell of each node
    for p in parents:
        owner.append(owner[-1][p])
    # from the ends of the phrases on: a state for each different set of arcs; 0 is final
    state = np.zeros(sizes[-1], np.int64)
    out: list[tuple[np.ndarray, ...]] = []  # cell, state, label, weight, target
    first = 1
    for d in range(len(parents) - 1, -1, -1):
        degree = np.bincount(parents[d], minlength=sizes[d])
        start = np.concatenate([[0], np.cumsum(degree)])
        mine = np.zeros(sizes[d], np.int64)
        for many in (1, 2, 3):  # states with few arcs are often equal; others hardly ever
            at = np.flatnonzero(degree == many) if d else np.zeros(0, np.int64)
            if len(at):
                arcs = start[at][:, None] + np.arange(many)
                table = np.concatenate([owner[d][at][:, None], labels[d][arcs], weights[d][arcs], state[arcs]], axis=1)
                order = np.lexsort(table.T[::-1])
                table = table[order]
                new = np.concatenate([[True], (table[1:] != table[:-1]).any(axis=1)])
                mine[at[order]] = first + np.cumsum(new) - 1
                kept = start[at[order[new]]][:, None] + np.arange(many)
                names = np.repeat(first + np.arange(new.sum()), many)
                kept = kept.ravel()
                out.append((np.repeat(table[new, 0], many), names, labels[d][kept], weights[d][kept], state[kept]))
                first += int(new.sum())
        at = np.flatnonzero(degree > 3) if d else root
        if len(at):
            mine[at] = first + np.arange(len(at))
            kept, _ = ragged(np.arange(len(labels[d])), start[at], degree[at])
            out.append((np.repeat(owner[d][at], degree[at]), np.repeat(mine[at], degree[at]), labels[d][kept], weights[d][kept], state[kept]))
            first += len(at)
        state = mine
    return cells, [np.concatenate(x) for x in zip(*out)]


def rows(cell: np.ndarray, grams: np.ndarray, counts: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """Cells in order, and the columns of AUTOMATON for each."""
    cells, (at, state, label, weight, target) = automata(cell, grams, counts)
    order = np.lexsort((label, state, at))
    at, state, label, weight, target = at[order], state[order], label[order], weight[order], target[order]
    begin = np.searchsorted(at, np.arange(len(cells) + 1))
    # states get numbers of their own in each cell, in order, from 1 on
    fresh = np.concatenate([[True], state[1:] != state[:-1]])
    number = np.cumsum(fresh)  # over all cells
    lowest = np.repeat(number[begin[:-1]], np.diff(begin))
    local = np.zeros(int(state.max()) + 1, np.int64)
    local[state] = number - lowest + 1
    target = np.where(target > 0, local[target], 0)
    heads = np.flatnonzero(fresh)
    degree = np.diff(np.append(heads, len(state)))
    by_state = np.searchsorted(heads, begin)
    # and words too
    base = np.int64(label.max() + 1)
    used, place = np.unique(at * base + label, return_inverse=True)
    by_word = np.searchsorted(used // base, np.arange(len(cells) + 1))
    label = place - np.repeat(by_word[:-1], np.diff(begin))
    lists = lambda offsets, values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return cells, [
        lists(by_word, vocabulary.take(pa.array(used % base))),
        lists(by_state, pa.array(degree, pa.int32())),
        lists(begin, pa.array(label, pa.int32())),
        lists(begin, pa.array(weight, pa.int64())),
        lists(begin, pa.array(target, pa.int32())),
    ]


class Automaton:
    """One row of AUTOMATON as arrays."""

    def __init__(self, batch: pa.RecordBatch, k: int) -> None:
        of = lambda name: batch.column(name)[k].values
        self.words = of("words")
        degree, self.label, self.weight, self.target = (of(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("degree", "label", "weight", "target"))
        self.start = np.concatenate([[0, 0], np.cumsum(degree)])
        self.root = len(self.start) - 2

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """Every phrase with a weight as a row of labels, padded with -1, in order of depth, and the weights."""
        state, path = np.array([self.root]), np.zeros((1, 0), np.int64)
        found, weights = [], []
        while len(state) and path.shape[1] < LONGEST:
            degree = self.start[state + 1] - self.start[state]
            arcs, _ = ragged(np.arange(len(self.label)), self.start[state], degree)
            path = np.concatenate([np.repeat(path, degree, axis=0), self.label[arcs][:, None]], axis=1)
            here = self.weight[arcs] > 0
            full = np.full((int(here.sum()), LONGEST), -1, np.int64)
            full[:, : path.shape[1]] = path[here]
            found.append(full)
            weights.append(self.weight[arcs][here])
            on = self.target[arcs] > 0
            state, path = self.target[arcs][on], path[on]
        return np.concatenate(found), np.concatenate(weights)


def composed(asks: Automaton, tells: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts): both automata walk together, arc by arc with equal words; asks carries places, tells counts."""
    same = pc.index_in(asks.words, value_set=tells.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    base = np.int64(len(tells.words) + 1)
    keys = np.repeat(np.arange(len(tells.start) - 1), np.diff(tells.start)) * base + tells.label  # ascending: arcs stand by state and label
    a, b = np.array([asks.root]), np.array([tells.root])
    places, counts = [], []
    while len(a):
        degree = asks.start[a + 1] - asks.start[a]
        arcs, _ = ragged(np.arange(len(asks.label)), asks.start[a], degree)
        want = same[asks.label[arcs]]
        key = np.repeat(b, degree) * base + want
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = (keys[at] == key) & (want >= 0)
        arcs, at = arcs[hit], at[hit]
        ends = asks.weight[arcs] > 0
        places.append(asks.weight[arcs][ends])
        counts.append(tells.weight[at][ends])
        on = (asks.target[arcs] > 0) & (tells.target[at] > 0)
        a, b = asks.target[arcs][on], tells.target[at][on]
    return np.concatenate(places), np.concatenate(counts)


# phrases and ranges


def text_hashes(vocabulary: pa.Array) -> np.ndarray:
    body, offsets = raw(vocabulary)
    return span_hashes(body, offsets[:-1], offsets[1:])


def prefix_ranges(grams: np.ndarray, hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a phrase: a hash of its first three words, or all if it has fewer."""
    h = np.zeros(len(grams), np.uint64)
    for d in range(min(3, grams.shape[1])):
        h = np.where(grams[:, d] >= 0, mix(h * _ODD + hashes[grams[:, d]] + np.uint64(1)), h)
    return (h % np.uint64(ranges)).astype(np.int64)


def pair_hashes(lang: int | np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix((one * _ODD + two) * _ODD + lang).astype(np.int64)


def _cut(body: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Parts of a long text, of about the given length, that end between pieces."""
    at, breaks = 0, None
    while len(body) - at > most:
        if breaks is None:
            breaks = np.flatnonzero(_BREAK[body]) + 1
        k = int(np.searchsorted(breaks, at + most, side="right"))
        to = int(breaks[k - 1]) if k and breaks[k - 1] > at else int(breaks[k]) if k < len(breaks) else len(body)
        yield body[at:to]
        at = to
    yield body[at:]


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(bytes, offsets of texts, language number of each text, names of the languages), of about `size` bytes each."""
    parts, langs, names, held = [], [], {}, 0

    def done():
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.concatenate(parts), offsets, np.array(langs, np.int64), list(names)

    for batch in batches:
        body, offsets = raw(batch.column("text"))
        for k, lang in enumerate(batch.column("lang").to_pylist()):
            for part in _cut(body[offsets[k] : offsets[k + 1]], size):
                if held and held + len(part) > size:
                    yield done()
                    parts, langs, names, held = [], [], {}, 0
                parts.append(part)
                langs.append(names.setdefault(lang, len(names)))
                held += len(part)
    if held:
        yield done()


def _sum(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal phrases summed up, in order. Word numbers are packed two by two, so that a sort has two keys, and one where no phrase is longer than a pair."""
    if not len(grams):
        return grams, counts
    base = np.int64(grams.max() + 2)
    some = [d for d in range(grams.shape[1]) if d < 2 or (grams[:, d] >= 0).any()]
    value = lambda d: grams[:, d] + np.int64(1)
    keys = [value(d[0]) * base + value(d[1]) if len(d) > 1 else value(d[0]) for d in (some[k : k + 2] for k in range(0, len(some), 2))]
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return grams[order[first]], np.add.reduceat(counts[order], first)


def _shard_phrases(body, offsets, lang, hashes_of, bits):
    """Phrases of a shard as (language, word numbers, count), with the vocabulary: words and pairs, or with a map of frequent pairs the longer ones."""
    body = lower_ascii(body)
    brk = _BREAK[body]
    starts, ends, row = words(body, offsets, _BREAK | _GAP)
    vocabulary, hashes = pa.array([], pa.string()), np.zeros(0, np.uint64)
    empty = np.zeros((0, LONGEST), np.int64)
    if not len(starts):
        return np.zeros(0, np.int64), empty, np.zeros(0, np.int64), vocabulary, hashes
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    told = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(body[~(_BREAK | _GAP)[body]])).dictionary_encode()
    vocabulary, word = told.dictionary, told.indices.to_numpy().astype(np.int64)
    hashes = text_hashes(vocabulary)
    piece = np.cumsum(brk, dtype=np.int32)[starts] + row
    langs, base = lang[row], np.int64(len(vocabulary))
    together = piece[1:] == piece[:-1]
    del body, brk, told, starts, ends, row, piece, at
    if bits is None:
        one, n1 = np.unique(langs * base + word, return_counts=True)
        at = np.flatnonzero(together)
        pair = (langs[at] * base + word[at]) * base + word[at + 1]
        two, n2 = np.unique(pair, return_counts=True)
        grams = np.full((len(one) + len(two), LONGEST), -1, np.int64)
        grams[: len(one), 0] = one % base
        grams[len(one) :, 0], grams[len(one) :, 1] = two // base % base, two % base
        return np.concatenate([one // base, two // base // base]), grams, np.concatenate([n1, n2]), vocabulary, hashes
    often = np.zeros(len(word), bool)  # the word and the next are a pair that may be frequent
    often[:-1] = together
    at = np.flatnonzero(often)
    often[at] = in_bits(pair_hashes(hashes_of[langs[at]], hashes[word[at]], hashes[word[at + 1]]), bits)
    three = np.flatnonzero(often[:-2] & often[1:-1])
    four = three[often[three + 2]]
    grams = np.full((len(three) + len(four), LONGEST), -1, np.int64)
    for d in range(3):
        grams[: len(three), d] = word[three + d]
    for d in range(4):
        grams[len(three) :, d] = word[four + d]
    owner = np.concatenate([langs[three], langs[four]])
    both, n = _sum(np.concatenate([owner[:, None], grams], axis=1), np.ones(len(grams), np.int64))
    return both[:, 0], both[:, 1:], n, vocabulary, hashes


def _named(lang: list[str]) -> np.ndarray:
    return text_hashes(pa.array(lang, pa.string()))


def _batch(cells: np.ndarray, columns: list[pa.Array], names: list[str], ranges: int, more: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    fields = {"lang": pa.array([names[c // ranges] for c in cells], pa.string()), "range": pa.array(cells % ranges, pa.int32())}
    fields |= dict(zip(("words", "degree", "label", "weight", "target"), columns)) | (more or {})
    return pa.RecordBatch.from_arrays(list(fields.values()), list(fields))


def counted(docs: DataFrame, ranges: int, bits: np.ndarray | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The transducers of all shards, a row for each language and range in it, with the words that they count (n)."""
    shared = docs.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches):
        for body, offsets, lang, names in shards(batches, shard_bytes):
            owner, grams, counts, vocabulary, hashes = _shard_phrases(body, offsets, lang, _named(names), shared.value if shared else None)
            if len(grams):
                cell = owner * ranges + prefix_ranges(grams, hashes, ranges)
                cells, columns = rows(cell, grams, counts, vocabulary)
                total = np.zeros(len(cells), np.int64)
                single = grams[:, 1] < 0
                np.add.at(total, np.searchsorted(cells, cell[single]), counts[single])
                yield _batch(cells, columns, names, ranges, {"n": pa.array(total, pa.int64())})
                del cell, cells, columns, total, single
            del body, offsets, lang, owner, grams, counts, vocabulary, hashes  # the next shard is gathered meanwhile

    return docs.mapInArrow(run, f"{CELL}, {AUTOMATON}, n long")


def united(parts: DataFrame, least: int, ranges: int) -> DataFrame:
    """One transducer for each language and range: weights of equal phrases are summed, phrases below `least` go.

    Rows stream through in order of language and range; at most PENDING phrases wait to be summed
    beside those that a range already has.
    """

    def run(batches):
        held: tuple[str, int] | None = None
        texts_, grams, counts, words_n, waiting = [], [], [], 0, 0

        def summed() -> tuple[pa.Array, np.ndarray, np.ndarray]:
            """All that waits, with one numbering of words."""
            codes = pa.concat_arrays(texts_).dictionary_encode()
            number, at = np.append(codes.indices.to_numpy(zero_copy_only=False).astype(np.int32), np.int32(-1)), 0
            for k, part in enumerate(texts_):
                grams[k] = number[np.where(grams[k] >= 0, grams[k] + at, -1)]
                at += len(part)
            return codes.dictionary, *_sum(np.concatenate(grams), np.concatenate(counts))

        def done():
            dictionary, g, c = summed()
            g, c = g[c >= least], c[c >= least]
            cells, columns = rows(np.zeros(len(g), np.int64), g.astype(np.int64), c, dictionary) if len(g) else (np.zeros(1, np.int64), [pa.array([[]], t) for t in (pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))])
            batch = _batch(np.array([0]), columns, [held[0]], ranges, {"n": pa.array([words_n], pa.int64())})
            return batch.set_column(1, "range", pa.array([held[1]], pa.int32()))

        for batch in batches:
            for k, key in enumerate(zip(batch.column("lang").to_pylist(), batch.column("range").to_pylist())):
                if key != held:
                    if held is not None:
                        yield done()
                    held, texts_, grams, counts, words_n, waiting = key, [], [], [], 0, 0
                part = Automaton(batch, k)
                g, c = part.phrases()
                texts_.append(part.words)
                grams.append(g.astype(np.int32))
                counts.append(c)
                words_n += batch.column("n")[k].as_py()
                waiting += len(g)
                if waiting > PENDING:
                    dictionary, g, c = summed()
                    texts_, grams, counts, waiting = [dictionary], [g], [c], 0
        if held is not None:
            yield done()

    dealt = parts.repartition("lang", "range").sortWithinPartitions("lang", "range")
    return dealt.mapInArrow(run, f"{CELL}, {AUTOMATON}, n long")


# parts and scores


def _candidates(own: Automaton, least: int) -> tuple[np.ndarray, np.ndarray]:
    g, c = own.phrases()
    some = (g[:, 1] >= 0) & (c >= least)
    return g[some], c[some]


def _parts(grams: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Different parts of phrases, padded, and for each phrase and cut (1, 2, 3) the places of its first part and its rest, or -1."""
    length = (grams >= 0).sum(axis=1)
    asked, at = [], []
    for k in (1, 2, 3):
        some = np.flatnonzero(length > k)
        first = np.where(np.arange(LONGEST) < k, grams[some], -1)
        rest = np.full((len(some), LONGEST), -1, np.int64)
        rest[:, : LONGEST - k] = grams[some, k:]
        asked += [first, rest]
        at += [some, some]
    parts, place = np.unique(np.concatenate(asked), axis=0, return_inverse=True)
    where = np.full((len(grams), 6), -1, np.int64)
    for column, (some, place_) in enumerate(zip(at, np.split(place.ravel(), np.cumsum([len(a) for a in asked])[:-1]))):
        where[some, column] = place_
    return parts, where


def questions(tables: DataFrame, least: int, ranges: int) -> DataFrame:
    """Acceptors of the parts that each range needs, addressed to the ranges that count them; weights are places, from 1 on."""

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                if not len(batch.column("words")[k].values):
                    continue
                own = Automaton(batch, k)
                grams, _ = _candidates(own, least)
                if not len(grams):
                    continue
                parts, _ = _parts(grams, len(own.words))
                cells, columns = rows(prefix_ranges(parts, text_hashes(own.words), ranges), parts, np.arange(1, len(parts) + 1), own.words)
                yield _batch(cells, columns, [batch.column("lang")[k].as_py()], ranges, {"asker": pa.array(np.full(len(cells), batch.column("range")[k].as_py()), pa.int32())})

    return tables.mapInArrow(run, f"{CELL}, {AUTOMATON}, asker int")


def answers(tables: DataFrame, asked: DataFrame) -> DataFrame:
    """Counts by place for each asking range: acceptors composed with the range's transducer."""

    def run(key, tells, asks):
        told = Automaton(tells.to_batches()[0], 0) if len(tells) else None
        lang, range_, places, counts = [], [], [], []
        for batch in asks.to_batches():
            for k in range(len(batch)):
                p, c = composed(Automaton(batch, k), told) if told is not None and len(told.words) else ([], [])
                lang.append(key[0].as_py())
                range_.append(batch.column("asker")[k].as_py())
                places.append(p)
                counts.append(c)
        return pa.table({"lang": pa.array(lang, pa.string()), "range": pa.array(range_, pa.int32()), "places": pa.array(places, pa.list_(pa.int64())), "counts": pa.array(counts, pa.list_(pa.int64()))})

    return tables.drop("n").groupBy("lang", "range").cogroup(asked.groupBy("lang", "range")).applyInArrow(run, f"{CELL}, places array<bigint>, counts array<bigint>")


def cut_scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """SCALE * a // (left + right) without leaving 64 bits: a is at most either part, so each step stays below 2,000 times the sum."""
    whole, rest = np.divmod(a * (SCALE // 1000), left + right)
    return whole * 1000 + rest * 1000 // (left + right)


def scored(tables: DataFrame, told: DataFrame, least: int) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every candidate: the cut with the lowest score, the earliest of them."""
    schema = "lang string, words array<string>, a long, l long, r long, score long"

    def run(key, own, answered):
        empty = pa.table({c.split()[0]: pa.array([], pa.list_(pa.string()) if "array" in c else pa.string() if "string" in c else pa.int64()) for c in schema.split(", ")})
        if not len(own) or not len(answered):
            return empty
        own = Automaton(own.combine_chunks().to_batches()[0], 0)
        grams, a = _candidates(own, least)
        parts, where = _parts(grams, len(own.words))
        count = np.zeros(len(parts) + 1, np.int64)
        places, counts = (answered.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("places", "counts"))
        count[places - 1] = counts
        best = left = right = None
        for k in range(3):
            there = where[:, 2 * k] >= 0
            one, two = count[where[:, 2 * k]], count[where[:, 2 * k + 1]]
            score = np.where(there, cut_scores(a, np.where(there, one, a), np.where(there, two, a)), np.int64(SCALE))
            if best is None:
                best, left, right = score, one, two
            else:
                lower = there & (score < best)
                best, left, right = np.where(lower, score, best), np.where(lower, one, left), np.where(lower, two, right)
        length = (grams >= 0).sum(axis=1)
        flat = own.words.take(pa.array(grams[grams >= 0]))
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), flat)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(grams), pa.string()), "words": listed, "a": a, "l": left, "r": right, "score": best})

    return tables.drop("n").groupBy("lang", "range").cogroup(told.groupBy("lang", "range")).applyInArrow(run, schema)


def maximal(found: DataFrame, share: int = 80) -> DataFrame:
    """Phrases that no longer one holds with nearly their count. A longer one's parts go out once each, with the largest count."""
    inner = F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda m: F.transform(F.sequence(F.lit(0), F.size("words") - m), lambda i: F.slice("words", i + 1, m)))
    longer = found.where(F.size("words") > 2).select("lang", F.explode(F.array_distinct(F.flatten(inner))).alias("words"), "a")
    most = longer.groupBy("lang", F.array_join("words", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    rows_ = found.select("lang", F.array_join("words", " ").alias("phrase"), "a", "l", "r", "score")
    held = rows_.join(most, ["lang", "phrase"], "left")
    return held.where(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(38,0)") < share * F.col("a").cast("decimal(38,0)"))).drop("longer")


def mined(docs: DataFrame, least: int = 30, share: int = 80, first: int = 2000, ranges: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    if spark.conf.get(BATCH_SETTING) == f"{BATCH_DEFAULT}b":
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")
    ranges = ranges or max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = docs.select(F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"))
    short = written(united(counted(text, ranges, None, shard_bytes), least, ranges), "phrases")
    long_ = written(united(counted(text, ranges, frequent_pairs(short, least), shard_bytes), least, ranges), "phrases")
    tables = written(united(short.unionByName(long_), least, ranges), "phrases")
    for done in (short, long_):
        drop_written(done)
    asked = questions(tables, least, ranges)
    found = written(scored(tables, answers(tables, asked), least), "candidates")
    totals = tables.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = maximal(found, share).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return best.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")  # totals: a row per language


def frequent_pairs(short: DataFrame, least: int) -> np.ndarray:
    """A bit map of the hashes of all frequent pairs."""

    def run(batches):
        for batch in batches:
            for k in range(len(batch)):
                if len(batch.column("words")[k].values):
                    own = Automaton(batch, k)
                    grams, _ = _candidates(own, least)
                    h = text_hashes(own.words)
                    lang = _named([batch.column("lang")[k].as_py()])[0]
                    yield pa.RecordBatch.from_arrays([pa.array(pair_hashes(lang, h[grams[:, 0]], h[grams[:, 1]]))], ["h"])

    arcs = short.agg(F.sum(F.size("label"))).first()[0] or 1
    return id_bits(short.mapInArrow(run, "h long"), "h", bits_for(arcs))
