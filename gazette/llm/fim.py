"""Fill-in-the-middle: each text is cut at two of its token ends and its parts are dealt out anew.

A token is a run of white space with the word after it, or the white space at the end of the text.
The bytes of a chunk of texts are viewed as words of 64 bits (SWAR). Arithmetic on whole words
marks the bytes that end a token; bitwise_count gives the marks of each word, a search in their
running sum finds the word that holds the k-th mark, and clearing the lowest marks of that word
resolves its place in it. No token is ever made into an object of its own.

Defined results: a null text is an empty one, and an empty text is plain. A null doc_id is hashed
as an empty one. White space only is one token. Rows that repeat give equal rows; columns other
than doc_id and text don't matter, whatever their names. A text of any length is one row: memory
is bounded by a chunk or, beyond it, by the longest single text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, raw, texts

#: The marks of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())


def _every(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW = _every(0x80), _every(0x7F)


def space_marks(word: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is 0x20 or 0x09 to 0x0D; no sum carries into a neighbour."""
    low = word & _LOW
    blank = ~((low ^ _every(0x20)) + _LOW)
    control = (low + _every(0x80 - 0x09)) & ~(low + _every(0x80 - 0x0E))
    return (blank | control) & ~word & _HIGH


def char_marks(word: np.ndarray) -> np.ndarray:
    """The high bit of each byte that begins a code point: all but 10xxxxxx."""
    return ~(word & ~(word << np.uint64(1))) & _HIGH


def padded(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as little-endian words of 64 bits, each text followed by a space or more up to a full word, and the n + 1 word offsets."""
    sizes = np.diff(offsets)
    at = np.concatenate([[0], np.cumsum(sizes // 8 + 1)])
    out = np.full(int(at[-1]) * 8, 0x20, np.uint8)
    out[np.arange(len(body)) + np.repeat(at[:-1] * 8 - offsets[:-1], sizes)] = body
    return out.view("<u8"), at


def end_marks(word: np.ndarray) -> np.ndarray:
    """The high bit of each byte that isn't white space and has white space after it. Every text ends in padding, so no mark depends on the next text."""
    space = space_marks(word)
    after = space >> np.uint64(8)
    after[:-1] |= space[1:] << np.uint64(56)
    after[-1:] |= np.uint64(0x80 << 56)
    return ~space & after & _HIGH


def select(marks: np.ndarray, running: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Byte positions of the k-th marks, counted from 1; running is the running sum of the marks of each word."""
    at = np.searchsorted(running, k, side="left")
    word = marks[at]
    left = (k - (running[at] - np.bitwise_count(word))).astype(np.int64)  # 1 to 8
    for _ in range(7):
        word = np.where(left > 1, word & (word - np.uint64(1)), word)
        left -= 1
    lowest = word & (~word + np.uint64(1))
    return at * 8 + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


def cuts(body: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: tokens, the byte ends of prefix and middle (from the text's start), and the code points of both parts."""
    word, at = padded(body, offsets)
    sizes = np.diff(offsets)
    if not len(sizes):
        return (np.zeros(0, np.int64),) * 5
    marks = end_marks(word)
    running = np.cumsum(np.bitwise_count(marks), dtype=np.int64)
    before = np.concatenate([[0], running])[at]
    ends = np.diff(before)
    last = np.zeros(len(sizes), bool)
    some = sizes > 0
    last[some] = ~np.isin(body[offsets[1:][some] - 1], (0x20, 9, 10, 11, 12, 13))
    n = ends + (some & ~last)  # white space at the end is a token of its own
    chars = np.cumsum(np.bitwise_count(char_marks(word)), dtype=np.int64)

    def byte_of(k: np.ndarray) -> np.ndarray:
        inside = (k > 0) & (k <= ends)
        out = np.where(k > 0, sizes, 0)
        out[inside] = select(marks, running, (before[:-1] + k)[inside]) + 1 - at[:-1][inside] * 8
        return out

    def points(to: np.ndarray) -> np.ndarray:
        """Code points before a byte of each text."""
        place = at[:-1] * 8 + to
        w, rest = place >> 3, (place & 7).astype(np.uint64)
        whole = np.where(w > 0, chars[w - 1], 0)
        part = char_marks(word[w]) & ((np.uint64(1) << (rest * np.uint64(8))) - np.uint64(1))  # no shift reaches 64
        base = np.where(at[:-1] > 0, chars[at[:-1] - 1], 0)
        return whole + np.bitwise_count(part) - base

    x, y = h1 % (n + 1), h2 % (n + 1)
    first, second = byte_of(np.minimum(x, y)), byte_of(np.maximum(x, y))
    p = points(first)
    return n, first, second, p, points(second) - p


def arranged(text: bytes, form: str, first: int, second: int) -> bytes:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return text


def restored(output: bytes, form: str) -> bytes:
    """The text that arranged() was given. No part holds a mark, so each mark is the first of its kind."""
    if form == "plain":
        return output
    inner = SUFFIX if form == "psm" else PREFIX
    one, rest = output[len(PREFIX) :].split(inner, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return b"".join((prefix, middle, suffix))


def draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four numbers of 32 bits for each id."""
    keys = (hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(b"".join(keys), ">u4").astype(np.int64).reshape(-1, 4)


def transformed(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42, outputs: bool = False) -> DataFrame:
    """Tokens, form, lengths and hashes of each document. rate: percent that stay plain from this draw on; spm: percent of the others with the suffix first.

    outputs adds the text as it was dealt out (output, string).
    """

    def run(batches):
        for ids, text in chunks(batches):
            body, offsets = raw(text)
            names = ids.to_pylist()
            h = draws(names, seed)
            n, first, second, prefix, middle = cuts(body, offsets, h[:, 0], h[:, 1])
            data = body.tobytes()
            out = []
            for k, doc in enumerate(names):
                mine = data[offsets[k] : offsets[k + 1]]
                plain = not mine or h[k, 2] % 100 >= rate or PREFIX in mine or SUFFIX in mine or MIDDLE in mine
                form = "plain" if plain else "spm" if h[k, 3] % 100 < spm else "psm"
                dealt = arranged(mine, form, first[k], second[k])
                lengths = (None, None) if plain else (int(prefix[k]), int(middle[k]))
                row = (doc, int(n[k]), form, *lengths, hashlib.sha256(dealt).hexdigest(), hashlib.sha256(restored(dealt, form)).hexdigest())
                out.append((*row, dealt.decode()) if outputs else row)
            kinds = (*_KINDS, pa.string()) if outputs else _KINDS
            fields = [c.split()[0] for c in SCHEMA.split(", ")] + ["output"] * outputs
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], fields)

    return texts(docs).mapInArrow(run, SCHEMA + ", output string" * outputs)
