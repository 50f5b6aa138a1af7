"""Words that a weak hash takes for equal, and runs of stars that a plain lattice can't get through."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from gazette.llm import decontaminate, fm_index, licences, ngrams, toxicity
from gazette.llm.common import PRIME, _times, span_hashes


def regular(n=11):
    """Two different words of 2^n letters a and b that collide under polynomials modulo a power of two."""
    signs = [0]
    for _ in range(n):
        signs += [1 - x for x in signs]
    return "".join("ab"[x] for x in signs), "".join("ba"[x] for x in signs)


def test_hash_of_spans():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, PRIME, 500, dtype=np.uint64), rng.integers(0, PRIME, 500, dtype=np.uint64)
    assert [int(x) for x in _times(a, b)] == [int(x) * int(y) % PRIME for x, y in zip(a, b)]
    for values in (rng.integers(97, 99, 600).astype(np.uint8), rng.integers(0, 2**64, 3, dtype=np.uint64)[rng.integers(0, 3, 600)]):
        starts = rng.integers(0, 590, 4000)
        ends = starts + rng.integers(0, 9, 4000)
        found = {}
        for h, s, e in zip(span_hashes(values, starts, ends), starts, ends):
            found.setdefault(values[s:e].tobytes(), set()).add(int(h))
        assert all(len(x) == 1 for x in found.values()) and len(set.union(*found.values())) == len(found)
    one, two = (np.frombuffer(w.encode(), np.uint8) for w in regular())
    both = np.concatenate([one, two])
    ends = np.array([len(one), len(both)])
    assert len(set(span_hashes(both, ends - len(one), ends).tolist())) == 2
    assert len(set(span_hashes(np.array([7, 2**63 + 5], np.uint64)[both - 97], ends - len(one), ends).tolist())) == 2


@pytest.fixture(scope="module")
def twins(spark):
    """Two documents of the same words but for one, which only looks equal to a weak hash."""
    same = " ".join(f"w{k}" for k in range(34))
    return spark.createDataFrame([(k, f"{same} {w}") for k, w in enumerate(regular())], "doc_id long, text string")


def test_different_words_stay(spark, twins):
    assert {r.doc_id: r.n_removed for r in fm_index.kept_words(twins).collect()} == {0: 0, 1: 0}
    assert [r.asDict()["component_id"] for r in ngrams.joined(twins, k=30, percent=95).orderBy("doc_id").collect()] == [0, 1]


def test_different_items_and_phrases(spark):
    one, two = regular()
    docs = spark.createDataFrame([(1, f"{one} {two} " * 6)], "doc_id long, text string")
    items = spark.createDataFrame([(1, f"{two} {two} {two} {two} {two} {two} {two} {two}")], "item_id long, text string")
    assert decontaminate.leaks(docs, items).count() == 0
    assert [r.base_labels for r in licences.scanned(spark.createDataFrame([(1, f"{one} mit license {two}")], "doc_id long, text string")).collect()] == ["mit"]


def channel():
    rng = np.random.default_rng(0)
    return toxicity.Channel(rng.poisson(0.05, (27,) * 4) * rng.integers(1, 500, (27,) * 4))


def lattice(token, model):
    """The plain walk over all readings that end in a state."""
    states = {0: (0.0, "")}
    for may in toxicity.emissions(token):
        new = {}
        for state, (score, read) in states.items():
            for symbol, cost in may:
                if symbol < 0 or (symbol == 0 and state % 27 == 0):
                    key, s, then = state, score + cost, read
                else:
                    key, s, then = 0 if symbol == 0 else (state * 27 + symbol) % 27**3, score + cost + model.log[state * 27 + symbol], read + ("abcdefghijklmnopqrstuvwxyz"[symbol - 1] if symbol else " ")
                if key not in new or s > new[key][0]:
                    new[key] = (s, then)
        states = new
    return max((s + (model.log[k * 27] if k else 0.0), k, read) for k, (s, read) in states.items())[2].strip()


def test_stars_are_read_as_in_the_plain_lattice():
    model, rng = channel(), random.Random(3)
    for _ in range(12):
        token = "".join(rng.choice("ab*3s-k") for _ in range(rng.randint(2, 5))) + rng.choice(["*", "*k", "**"])
        assert toxicity.decode(token, model) == lattice(token, model), token


def test_long_runs_of_stars_end():
    model, began = channel(), time.time()
    told = {n: toxicity.decode("x" + "*" * n + "y", model) for n in (model.longest, 1_000, 100_000)}
    assert len(set(told.values())) == 1 and time.time() - began < 30
    text = pa.array(["x" + "*" * 50_000 + "y and more"])
    assert toxicity.restored(text, lambda t: toxicity.decode(t, model)).to_pylist()[0].endswith("and more")
