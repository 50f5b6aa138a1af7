"""BPE encoding and decoding as a bounded-lookahead streaming transducer (operator 10).

A *piece* is one run of the tokenizer's split pattern, as byte symbols, the last one with
the end-of-word mark. The merge list fixes how far to the right of a token the input can
still change it (`lookahead`). The transducer keeps a window of symbols, merges it, and
emits each token that ends at least that far before the window's end, and the rest once the
piece has ended. A text is read in slices of bounded length, cut where neither the
normalisation nor a piece is touched, or inside a piece that then goes on streaming; so neither
a long text nor a long piece takes more memory. What the transducer gave for a run without white
space is kept for the next one like it, in a cache of bounded size. Decoding feeds ids, block by
block, to a state machine that holds back the bytes of an unfinished character.

Defined cases: null and empty texts have no tokens and decode to the empty text; texts
of white space alone likewise; the strings of special tokens become those tokens.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import texts

#: White space as the tokenizer's normaliser sees it. Python's own str.split() also splits at these controls:
_CONTROLS = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {b: chr(b) for b in plain}, 0x100
    for b in range(256):
        if b not in out:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


def lookahead(merges: list[tuple[str, str]], width) -> int:
    """Symbols to the right of a token's end that can still change it.

    A merge (u, v) fails to happen because of what stands further right only if an earlier
    merge (x, y) starts inside v and crosses its end, which needs x to be a suffix of v. That
    merge in turn may hang on still earlier ones at the end of y. `reach[x]` is how far
    beyond x the merges with left part x, listed so far, can depend; one pass in list order
    gives the longest chain.
    """
    reach: dict[str, int] = {}
    most = 0
    for u, v in merges:
        beyond = max((reach.get(v[i:], 0) for i in range(len(v))), default=0)
        far = width(v) + beyond
        if far > reach.get(u, 0):
            reach[u] = far
        most = max(most, far)
    return most


#: Characters that are read at a time.
SLICE = 1 << 16


def _may_cut(c: str) -> bool:
    """Whether a text may be cut before this character: it never composes with what stands before it."""
    return unicodedata.category(c)[0] != "M" and not "\u1160" <= c <= "\u11ff"


def _coded(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Decoder:
    """Ids in, text out, block by block; bytes wait until they end a character."""

    def __init__(self, pieces: list[bytes], between: bytes):
        self.pieces, self.between, self.started = pieces, between, False
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        body = self.between.join(map(self.pieces.__getitem__, ids))
        if ids and self.started:
            body = self.between + body
        self.started |= bool(ids)
        return self.state.decode(body)

    def end(self) -> str:
        return self.state.decode(b"", True)


class Transducer:
    """Encodes and decodes with one public BPE vocabulary; made once in each Python worker."""

    def __init__(self, path: str, cache: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {self.ids[a] << 32 | self.ids[b]: i for i, (a, b) in enumerate(merges)}
        self.made = [self.ids[a + b] for a, b in merges]
        self.widths = {i: self.width(t) for t, i in self.ids.items()}
        self.lookahead = lookahead(merges, self.width)
        self.window = 4 * self.lookahead
        symbols = byte_symbols()
        self.plain, self.last = [self.ids[s] for s in symbols], [self.ids[s + self.end] for s in symbols]
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.runs: list[dict[str, bytes]] = [{}, {}]
        self.pieces: list[dict[str, list[int]]] = [{}, {}]
        self.cache_size = cache
        back = {s: b for b, s in enumerate(symbols)}
        names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.told = [names.get(i, "").encode("utf-8") for i in range(max(names) + 1)]
        self.readable = [b""] * len(self.told)
        for t, i in self.ids.items():
            word = bool(self.end) and t.endswith(self.end)
            self.readable[i] = bytes(back[c] for c in (t.removesuffix(self.end) if word else t) if c in back) + b" " * word
        for t, i in self.special.items():
            self.readable[i] = t.encode("utf-8")

    def width(self, token: str) -> int:
        return len(token.removesuffix(self.end)) if self.end else len(token)

    # encoding

    def merged(self, ids: list[int]) -> list[int]:
        """All merges inside one window of token ids: the earliest listed pair first, the leftmost of equals."""
        if len(ids) > 64:
            return self._merged_long(ids)
        get, made = self.ranks.get, self.made
        none = len(made)
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for windows of many symbols."""
        get, made, n = self.ranks.get, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, k) for i, k in enumerate(a << 32 | b for a, b in zip(ids, ids[1:])) if (r := get(k)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, key = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] < 0 or ids[i] << 32 | ids[j] != key:  # one of the two is gone or has grown
                continue
            ids[i], ids[j] = made[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := get(k := ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, k))
        return [t for t in ids if t >= 0]

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Tokens of one piece, each as soon as nothing further right can change it."""
        window: list[int] = []
        for s in symbols:
            window.append(s)
            if len(window) >= self.window:
                done = 0
                for token in self.merged(window.copy()):
                    size = self.widths[token]
                    if done + size + self.lookahead > len(window):
                        break
                    done += size
                    yield token
                window = window[done:]
        yield from self.merged(window)

    def marked(self, parts: Iterable[str]) -> Iterator[int]:
        """The byte symbols of a piece given in parts; the last one carries the end-of-word mark."""
        held = None
        for part in parts:
            for b in part.encode("utf-8"):
                if held is not None:
                    yield self.plain[held]
                held = b
        yield self.last[held]

    def kept(self, cache: list[dict], key: str, value):
        """Keep a short key. What is kept is bounded: a full generation becomes the older one, which goes in its turn."""
        if len(key) <= 64:
            if len(cache[0]) >= self.cache_size:
                cache[1] = cache[0].copy()
                cache[0].clear()
            cache[0][key] = value
        return value

    def piece(self, piece: str) -> list[int]:
        found = self.pieces[0].get(piece)
        if found is None:
            found = self.pieces[1].get(piece)
            if found is None:
                body = piece.encode("utf-8")
                symbols = [self.plain[b] for b in body]
                symbols[-1] = self.last[body[-1]]
                found = self.merged(symbols) if len(symbols) < self.window else list(self.stream(symbols))  # a short piece ends before the first token is stable
            self.kept(self.pieces, piece, found)
        return found

    def normal(self, text: str) -> str:
        return (text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")).lower()

    def run(self, run: str) -> bytes:
        """Ids (little-endian, 32 bits) of a run without white space. Pieces never cross white space."""
        found = self.runs[1].get(run)
        if found is None:
            found = _coded([i for p in self.split.findall(self.normal(run)) for i in self.piece(p)])
        return self.kept(self.runs, run, found)

    def blocks(self, text: str) -> Iterator[bytes]:
        """The ids of a text, block by block."""
        at = 0
        for m in self.marks.finditer(text) if self.marks and "<|" in text else ():
            yield from self._plain(text, at, m.start())
            yield _coded([self.special[m[0]]])
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, stop: int) -> Iterator[bytes]:
        get, run = self.runs[0].get, self.run
        while at < stop:
            to = min(at + SLICE, stop)
            if to < stop:
                cut = max(text.rfind(" ", at + 1, to), text.rfind("\n", at + 1, to))
                if cut < 0:  # a run of more than a slice, from here or from the last white space that isn't a blank or a new line
                    found = list(_SPACE.finditer(text, at + 1, to))
                    cut = found[-1].start() if found else -1
                if cut < 0:
                    end = _SPACE.search(text, at + 1, stop)
                    to = end.start() if end else stop
                    yield from self._long(text, at, to)
                    at = to
                    continue
                to = cut
            part = text[at:to]
            at = to
            runs = [p for p in _SPACE.split(part) if p] if _CONTROLS.search(part) else part.split()
            yield b"".join([get(p) or run(p) for p in runs])

    def _parts(self, text: str, at: int, stop: int) -> Iterator[str]:
        """A long run, normalised, in parts."""
        while at < stop:
            to = min(at + SLICE, stop)
            while to < stop and not _may_cut(text[to]):
                to += 1
            yield self.normal(_SPACE.sub("", text[at:to]))
            at = to

    def _long(self, text: str, at: int, stop: int) -> Iterator[bytes]:
        """A run without white space inside that is longer than a slice: its pieces are told part by part, and a piece that is longer still is streamed."""
        parts, rest, over = self._parts(text, at, stop), "", False

        def more() -> bool:
            nonlocal rest, over
            got = next(parts, None)
            over = got is None
            rest += got or ""
            return not over

        def open_piece(kind: regex.Pattern) -> Iterator[str]:
            nonlocal rest
            while True:
                part = kind.match(rest)
                if part:
                    rest = rest[part.end() :]
                    yield part[0]
                if rest or not more():
                    return

        while more():
            done, out = 0, []
            for m in self.split.finditer(rest):
                if m.end() + 2 > len(rest):  # what follows may still belong to it
                    break
                out += self.piece(m[0])
                done = m.end()
            rest = rest[done:]
            yield _coded(out)
            if len(rest) > max(SLICE // 2, 8):
                kind = regex.compile(r"\p{L}+" if regex.match(r"\p{L}", rest) else r"[^\s\p{L}\p{N}]+")
                block: list[int] = []
                for token in self.stream(self.marked(open_piece(kind))):
                    block.append(token)
                    if len(block) >= SLICE:
                        yield _coded(block)
                        block = []
                yield _coded(block)
        yield _coded([i for p in self.split.findall(rest) for i in self.piece(p)])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join(self.blocks(text or "")), "<u4").tolist()

    # decoding

    def decoder(self) -> Decoder:
        """Decodes as the library does where the vocabulary names no decoder: the tokens, joined by one space."""
        return Decoder(self.told, b" ")

    def reader(self) -> Decoder:
        """Decodes to readable text: bytes as they were, an end-of-word mark as a space."""
        return Decoder(self.readable, b"")

    def decode(self, ids: Iterable[int]) -> str:
        state = self.decoder()
        return state.feed(list(ids)) + state.end()

    def text_of(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text, token by token."""
        state = self.reader()
        for i in ids:
            yield state.feed([i])
        yield state.end()

    def digest(self, text: str) -> tuple[int, str, str]:
        """n_tokens and the hashes of ids and decoded text, fed block by block."""
        ids, decoded, n, state = hashlib.sha256(), hashlib.sha256(), 0, self.decoder()
        for block in self.blocks(text):
            ids.update(block)
            n += len(block) // 4
            decoded.update(state.feed(np.frombuffer(block, "<u4").tolist()).encode("utf-8"))
        decoded.update(state.end().encode("utf-8"))
        return n, ids.hexdigest(), decoded.hexdigest()


_made: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _made:
        _made[path] = Transducer(path)
    return _made[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids array<int>, decoded string (as the library decodes) and restored string (readable)."""

    def run(batches):
        coder = transducer(path)
        for batch in batches:
            ids = [coder.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([coder.decode(x) for x in ids]), pa.array(["".join(coder.text_of(x)) for x in ids])],
                ["doc_id", "n_tokens", "ids", "decoded", "restored"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded string, restored string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        coder = transducer(path)
        for batch in batches:
            n, a, b = zip(*map(coder.digest, batch.column("text").to_pylist())) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
