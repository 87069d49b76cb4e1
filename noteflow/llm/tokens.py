"""Exact token ids of many texts at once, with a byte-level BPE file of a public tokenizer.

Such a tokenizer first cuts a text by a fixed pattern and then encodes each piece by itself. Here numpy
finds the cuts of a whole batch of texts, equal pieces are grouped, and the tokenizer encodes every
distinct piece once; ids of known pieces are remembered, up to a bound. Grouping goes by a 64-bit hash
and is then compared character by character, so the ids are the tokenizer's own. Texts with characters
whose class could differ between Unicode versions go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from noteflow.llm.bytenet import slices

#: White space of the cutting pattern, below U+2070.
SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F)
#: Endings that the pattern cuts off after an apostrophe.
SHORT, LONG = "stmd", ("re", "ve", "ll")
LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
#: Characters cut at once, and distinct pieces remembered by one worker.
BATCH_CHARS = 1 << 19
MOST_PIECES = 300_000
#: Distinct pieces that go through the tokenizer as one text.
LINES = 1000
DEFAULT_VOCABULARY = "byte_bpe_50k.json"
_HASH = np.uint64(0x9E3779B97F4A7C15)

_PLAIN = re.compile(r" ?\S+").fullmatch

_coders: dict[str, ByteCoder] = {}


def coder(vocabulary: str | None = None) -> ByteCoder:
    """The coder of this worker for a vocabulary file; by default the one of the installed package."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(DEFAULT_VOCABULARY)
    if vocabulary not in _coders:
        _coders[vocabulary] = ByteCoder(vocabulary)
    return _coders[vocabulary]


def _classes() -> np.ndarray:
    table = np.full(0x110000, UNSURE, np.uint8)
    for c in range(0x2070):
        kind = unicodedata.category(chr(c))
        table[c] = {"L": LETTER, "N": NUMBER}.get(kind[0], UNSURE if kind == "Cn" else OTHER)
    table[list(SPACES)] = SPACE
    return table


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class ByteCoder:
    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        # The strings of special tokens are ordinary text in a document.
        self.tokenizer.encode_special_tokens = True
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else -1
        self.pieces = Pieces()
        self.classes = _classes()
        self.inverse = np.uint64(pow(int(_HASH), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of pieces. Those without white space inside go through the tokenizer as lines of one text."""
        plain = [p for p in pieces if _PLAIN(p)]
        pages = [plain[at : at + LINES] for at in range(0, len(plain), LINES)]
        for lines, coded in zip(pages, self._whole(["\n".join(p) for p in pages])):
            ids = np.frombuffer(coded, "<u4")
            breaks = np.flatnonzero(ids == self.line)
            if len(breaks) == len(lines) - 1:
                edges = [-1, *breaks.tolist(), len(ids)]
                yield from zip(lines, (ids[a + 1 : b].tobytes() for a, b in zip(edges[:-1], edges[1:])))
            else:
                yield from zip(lines, self._whole(lines))
        rest = list(set(pieces).difference(plain))
        yield from zip(rest, self._whole(rest))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        parts: list[str] = []
        owners: list[int] = []
        size = done = 0
        pending: dict[int, list[np.ndarray]] = {}

        def flush() -> None:
            for owner, ids in zip(owners, self._batch(parts)):
                pending.setdefault(owner, []).append(ids)
            parts.clear()
            owners.clear()

        for k, text in enumerate(texts):
            for piece in _slices(text):
                parts.append(piece)
                owners.append(k)
                size += len(piece)
                if size >= BATCH_CHARS:
                    flush()
                    size = 0
                    while done < k:
                        yield _joined(pending.pop(done))
                        done += 1
        flush()
        while done < len(texts):
            yield _joined(pending.pop(done))
            done += 1

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        big = "".join(texts)
        if not big:
            return [np.empty(0, "<u4") for _ in texts]
        chars = np.frombuffer(big.encode("utf-32-le"), "<u4")
        kinds = self.classes[chars]
        if (kinds == UNSURE).any():
            if len(texts) == 1:
                return [np.frombuffer(x, "<u4") for x in self._whole(texts)]
            plain = [k for k, t in enumerate(texts) if not (self.classes[np.frombuffer(t.encode("utf-32-le"), "<u4")] == UNSURE).any()]
            odd = sorted(set(range(len(texts))) - set(plain))
            out: dict[int, np.ndarray] = dict(zip(plain, self._batch([texts[k] for k in plain])))
            out |= {k: np.frombuffer(x, "<u4") for k, x in zip(odd, self._whole([texts[k] for k in odd]))}
            return [out[k] for k in range(len(texts))]
        ends = np.cumsum([len(t) for t in texts])
        cuts = _cuts(chars, kinds, ends)
        ids, lengths = self._ids(big, chars, cuts)
        # Tokens before each piece, read off at the text boundaries.
        before = np.concatenate([[0], np.cumsum(lengths)])
        at = before[np.searchsorted(cuts, np.concatenate([[0], ends]))]
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]

    def _ids(self, big: str, chars: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(chars)
        if len(self.up) <= n:
            size = max(n + 1, BATCH_CHARS + (BATCH_CHARS >> 1))
            self.up, self.down = _powers(_HASH, size), _powers(self.inverse, size)
        sizes = np.diff(np.append(cuts, n))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        hashes = ((sums[cuts + sizes] - sums[cuts]) * self.down[cuts] + sizes.astype(np.uint64)) * _HASH
        at = self.pieces.find(hashes)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            new, first, group = np.unique(hashes[miss], return_index=True, return_inverse=True)
            starts = cuts[miss[first]]
            texts = [big[a:b] for a, b in zip(starts.tolist(), (starts + sizes[miss[first]]).tolist())]
            coded = dict(self._new(texts))
            if self.pieces.n + len(texts) > MOST_PIECES:
                # Full: begin anew, unless this batch alone has too many.
                again, self.pieces = self.pieces.n > 0, Pieces()
                return self._ids(big, chars, cuts) if again else self._plain(big, cuts, sizes)
            at[miss] = self.pieces.add(new, texts, [coded[t] for t in texts])[group]
        return self.pieces.read(at, chars, cuts, sizes) or self._plain(big, cuts, sizes)

    def _plain(self, big: str, cuts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without what is remembered: for more pieces than that may be, and for equal hashes of different pieces."""
        ids = self._whole([big[a:b] for a, b in zip(cuts.tolist(), (cuts + sizes).tolist())])
        return np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids])


class Pieces:
    """Remembered pieces: characters and ids, found by hash in one of two slots."""

    def __init__(self, bits: int = 20):
        self.n, self.bits = 0, bits
        self.hashes, self.slots = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.ids, self.chars = Grown("<u4"), Grown("<u4")
        self.id_ends, self.char_ends = Grown(np.int64), Grown(np.int64)
        self.id_ends.add(np.zeros(1, np.int64))
        self.char_ends.add(np.zeros(1, np.int64))

    def _both(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64), ((hashes >> np.uint64(20)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        one, two = self._both(hashes)
        at = np.where(self.hashes[one] == hashes, self.slots[one], -1)
        rest = np.flatnonzero(at < 0)
        two = two[rest]
        at[rest] = np.where(self.hashes[two] == hashes[rest], self.slots[two], -1)
        return at

    def add(self, hashes: np.ndarray, texts: list[str], ids: list[bytes]) -> np.ndarray:
        numbers = np.arange(self.n, self.n + len(texts), dtype=np.int32)
        one, two = self._both(hashes)
        slot = np.where(self.slots[one] < 0, one, two)
        self.hashes[slot], self.slots[slot] = hashes, numbers
        self.n += len(texts)
        self.ids.add(np.frombuffer(b"".join(ids), "<u4"))
        self.chars.add(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4"))
        self.id_ends.add(self.id_ends.all()[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4))
        self.char_ends.add(self.char_ends.all()[-1] + np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))))
        return numbers

    def read(self, at: np.ndarray, chars: np.ndarray, cuts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and how many of each piece, after comparing the characters; None if any differ."""
        ends, begins = self.char_ends.all()[1:][at], self.char_ends.all()[:-1][at]
        if not (ends - begins == sizes).all() or not (self.chars.all()[_spread(begins, sizes)] == chars).all():
            return None
        begins = self.id_ends.all()[:-1][at]
        lengths = self.id_ends.all()[1:][at] - begins
        return self.ids.all()[_spread(begins, lengths)], lengths


class Grown:
    """An array that grows in place."""

    def __init__(self, kind):
        self.data, self.n = np.empty(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.empty(self.n + 2 * len(more), self.data.dtype)])
        self.data[self.n : self.n + len(more)] = more
        self.n += len(more)

    def all(self) -> np.ndarray:
        return self.data[: self.n]


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... for sizes[0] places, then begins[1], ..."""
    ahead = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begins - ahead, sizes)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _slices(text: str) -> Iterator[str]:
    """A long text in parts, cut before single spaces between visible characters: there the pattern cuts too."""
    at = 0
    while len(text) - at > BATCH_CHARS:
        cut = text.rfind(" ", at + 1, at + BATCH_CHARS)
        while cut > at and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", at + 1, cut)
        if cut <= at:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _cuts(chars: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pieces of the pattern begin. ``ends``: where each text ends."""
    n = len(chars)
    begins = np.zeros(n + 1, bool)
    begins[0] = True
    begins[ends] = True
    cut = begins.copy()
    cut[1:n] |= kinds[1:] != kinds[:-1]
    # The last of some white space before a visible character is a piece of its own; a plain space joins what follows.
    after = np.flatnonzero((kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~begins[1:n]) + 1
    cut[after - 1] = True
    cut[after[chars[after - 1] == 0x20]] = False
    marks = np.flatnonzero((chars[: n - 1] == 0x27) & cut[: n - 1] & (kinds[1:] == LETTER) & ~begins[1:n])
    one = np.isin(chars[marks + 1], [ord(c) for c in SHORT])
    two = np.zeros(len(marks), bool)
    more = np.flatnonzero(marks + 2 < n)
    inside = ~begins[marks[more] + 2]
    for a, b in LONG:
        two[more] |= inside & (chars[marks[more] + 1] == ord(a)) & (chars[marks[more] + 2] == ord(b))
    for hit, size in ((one, 1), (two & ~one, 2)):
        cut[marks[hit] + 1] = False
        cut[marks[hit] + 1 + size] = True
    return np.flatnonzero(cut[:n])


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: str | None = None) -> Iterator[tuple[pa.RecordBatch, Iterator[np.ndarray]]]:
    """Every batch, some rows at a time, with the ids of its ``text`` column; null counts as empty."""
    for batch in slices(batches):
        yield batch, coder(vocabulary).encode([t or "" for t in batch.column("text").to_pylist()])
