"""Licence scans (operator 8): a positional rare-token index over licence notices.

1. Document frequencies of the templates' words are counted over all documents.
2. A file is held against the templates whose key phrases have all their words in it. For each of
   these the file's words of highest IDF that the template holds (`rarest` of them) are looked up.
   Their postings are intersected by relative position: an occurrence at p of a word that
   stands at i in the template says that the template begins at p - i. Beginnings that lie within
   `slack` of each other are one alignment, so words put in or left out don't part it.
   It needs two words, or all words of a template that has only one.
3. An alignment counts if the template's mandatory key phrases stand there, give or take
   `slack` words; its score is the share of the template's words that stand in place.

Base places are exact runs of the fixed phrases. Labels of the method come on top. Templates are a
parameter: (label, text, key phrases), whole notices or single lines.

Defined cases: null and empty texts have no words, places or labels and score 0; phrases never
cross documents; repeated rows are scanned each for itself, a row without a doc_id too; ties in IDF
go by the word; other columns go; templates without words or key phrases find nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lower_ascii, raw, span_hashes, texts, words
from .licence_texts import TEMPLATES

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Words are runs of small letters, digits and bytes from 0x80 on.
GAP = np.zeros(256, bool)
GAP[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def word_hashes(many: list[str]) -> np.ndarray:
    body = np.frombuffer("".join(many).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in many]).astype(np.int64)
    return span_hashes(body, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if many else np.zeros(0, np.uint64)


def split(text: str) -> list[str]:
    """The words of a template, as in documents."""
    return regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


@dataclass
class Index:
    """The vocabulary of the templates (hashes, in order), how rare its words are, and each template as places in it."""

    labels: list[str]
    words: np.ndarray
    rank: np.ndarray  # 0 for the rarest word
    forms: list[np.ndarray]
    phrases: list[list[tuple[int, np.ndarray]]]
    needed: np.ndarray  # template x word: whether a key phrase holds the word
    rarest: int

    @staticmethod
    def of(templates: tuple, seen: dict[str, int], rarest: int) -> "Index":
        forms = [split(text) for _, text, _ in templates]
        names = sorted({w for f in forms for w in f})
        h = word_hashes(names)
        order = np.argsort(h)
        names = [names[i] for i in order]
        place = {w: i for i, w in enumerate(names)}
        by_idf = sorted(range(len(names)), key=lambda i: (seen.get(names[i], 0), names[i]))
        rank = np.zeros(len(names), np.int64)
        rank[by_idf] = np.arange(len(names))
        phrases, needed = [], np.zeros((len(templates), len(names)), bool)
        for t, (form, (_, _, keys)) in enumerate(zip(forms, templates)):
            found = []
            for key in map(split, keys):
                at = next((i for i in range(len(form)) if key and form[i : i + len(key)] == key), None)
                if at is not None:
                    found.append((at, np.array([place[w] for w in key])))
                    needed[t, found[-1][1]] = True
            phrases.append(found)
        return Index([t[0] for t in templates], h[order], rank, [np.array([place[w] for w in f], np.int64) for f in forms], phrases, needed, rarest)

    def found(self, h: np.ndarray, rows: np.ndarray, n: int, slack: int) -> dict[int, dict[str, float]]:
        """Per row: labels and scores of the alignments whose key phrases stand there."""
        out: dict[int, dict[str, float]] = {}
        if not len(h) or not len(self.words):
            return out
        code = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        code = np.where(self.words[code] == h, code, -1)
        at = np.flatnonzero(code >= 0)
        holds = np.zeros((n, len(self.words)), bool)
        holds[rows[at], code[at]] = True
        missing = (~holds).astype(np.int32) @ self.needed.T.astype(np.int32)
        firsts = np.searchsorted(rows, np.arange(n + 1))
        for r, t in zip(*np.nonzero((missing == 0) & self.needed.any(1))):
            score = self._aligned(code[firsts[r] : firsts[r + 1]], int(t), holds[r], slack)
            if score > 0:
                mine = out.setdefault(int(r), {})
                mine[self.labels[t]] = max(mine.get(self.labels[t], 0.0), score)
        return out

    def _aligned(self, text: np.ndarray, t: int, holds: np.ndarray, slack: int) -> float:
        """The best score of the template in one file (vocabulary places, -1 elsewhere), 0 if it doesn't stand there."""
        form = self.forms[t]
        mine = np.unique(form[holds[form]])
        looked = mine[np.argsort(self.rank[mine])][: self.rarest]
        begins, by = [], []
        for w in looked:
            b = (np.flatnonzero(text == w)[:, None] - np.flatnonzero(form == w)[None, :]).ravel()
            begins.append(b)
            by.append(np.full(len(b), w))
        begins, by = np.concatenate(begins), np.concatenate(by)
        order = np.argsort(begins, kind="stable")
        begins, by = begins[order], by[order]
        best = 0.0
        for part in np.split(np.arange(len(begins)), np.flatnonzero(np.diff(begins) > slack) + 1):
            if len(np.unique(by[part])) >= min(2, len(looked)):
                best = max(best, self._score(text, t, begins[part], slack))
        return best

    def _score(self, text: np.ndarray, t: int, begins: np.ndarray, slack: int) -> float:
        form = self.forms[t]
        shifts = np.unique(begins[:, None] + np.arange(-slack, slack + 1))

        def stands(at: int, want: np.ndarray) -> bool:
            """Whether the words stand at that place of the template under one of the shifts."""
            p = shifts + at
            p = p[(p >= 0) & (p + len(want) <= len(text))]
            return bool(len(p)) and bool((text[p[:, None] + np.arange(len(want))] == want).all(1).any())

        if not all(stands(at, want) for at, want in self.phrases[t]):
            return 0.0
        there = np.zeros(len(form), bool)
        for b in np.unique(begins):
            i = np.arange(max(0, -b), min(len(form), len(text) - b))
            there[i] |= text[b + i] == form[i]
        return float(there.mean())


def _words_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    body, offsets = raw(text)
    body = lower_ascii(body)
    starts, ends, rows = words(body, offsets, GAP)
    return span_hashes(body, starts, ends), rows


def frequencies(docs: DataFrame, templates: tuple) -> dict[str, int]:
    """In how many documents each template word stands: the templates' vocabulary, all documents."""
    if not any(split(text) for _, text, _ in templates):
        return {}
    names = sorted({w for _, text, _ in templates for w in split(text)})
    h = word_hashes(names)
    order = np.argsort(h)
    known = h[order]

    def run(batches):
        total = np.zeros(len(known), np.int64)
        for _, text in chunks(batches):
            hashes, rows = _words_of(text)
            if len(hashes):
                k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[k] == hashes
                total += np.bincount(np.unique(rows[hit] * len(known) + k[hit]) % len(known), minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(known)), pa.int32()), pa.array(total)], ["k", "n"])

    rows = {r["k"]: r["n"] for r in texts(docs).mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
    return {names[order[k]]: n for k, n in rows.items()}


def scanned(docs: DataFrame, templates: tuple = TEMPLATES, rarest: int = 4, slack: int = 2) -> DataFrame:
    """One row per document: word count, base places and labels, all labels and the best score."""
    index = Index.of(templates, frequencies(docs, templates), rarest)
    base = [(label, word_hashes(phrase.split())) for phrase, label in BASE.items()]

    def run(batches):
        for ids, text in chunks(batches):
            h, rows = _words_of(text)
            n = len(ids)
            counts = np.bincount(rows, minlength=n)
            begins = np.cumsum(counts) - counts
            places, firsts, lasts = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
            own: list[set[str]] = [set() for _ in range(n)]
            for label, want in base:
                at = np.flatnonzero(h == want[0])
                at = at[at + len(want) <= len(h)]
                for j in range(1, len(want)):
                    at = at[(h[at + j] == want[j]) & (rows[at + j] == rows[at])]
                for r, w in zip(rows[at].tolist(), (at - begins[rows[at]]).tolist()):
                    places[r] += 1
                    firsts[r] = w if firsts[r] < 0 else min(w, firsts[r])
                    lasts[r] = max(w, lasts[r])
                    own[r].add(label)
            more = index.found(h, rows, n, slack)
            labels = [",".join(sorted(own[r] | set(more.get(r, ())))) for r in range(n)]
            score = [max([1.0 if own[r] else 0.0, *more.get(r, {}).values()]) for r in range(n)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(places), pa.array(firsts, mask=firsts < 0), pa.array(lasts, mask=lasts < 0), pa.array([",".join(sorted(o)) for o in own], pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64())],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
