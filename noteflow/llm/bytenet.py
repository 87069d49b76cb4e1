"""A small convolutional network over bytes, in numpy: windows, filters, max pooling, training.

A text is cut into overlapping windows of ``window`` bytes that cover it from end to end; consecutive windows
share enough bytes that every filter position lies inside one. Filters have several widths and move in steps
of ``unit`` bytes. Each filter keeps its maximum over a window (``Filters.features``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Windows that go through the filters at once.
SLAB = 128


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row in them; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, which bounds what a worker makes of them at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Filters:
    """``banks``: (width in units, number of filters) pairs."""

    def __init__(self, window: int, unit: int, depth: int, banks: tuple[tuple[int, int], ...], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.window, self.unit, self.depth, self.banks = window, unit, depth, banks
        self.places = window // unit
        self.step = window - unit * (max(w for w, _ in banks) - 1)
        self.n = sum(f for _, f in banks)
        self.embed = rng.normal(0, 0.5, (256, depth)).astype(np.float32)
        self.embed[0] = 0
        wide = sum(w * f for w, f in banks)
        scale = np.concatenate([np.full(w * f, (w * unit * depth) ** -0.5) for w, f in banks])
        self.weights = (rng.normal(0, 1, (unit * depth, wide)) * scale * 1.5).astype(np.float32)
        self.bias = np.zeros(self.n, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.weights, self.bias]

    def cut(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, start in row) of all windows; a row without bytes has one empty window."""
        overlap = self.window - self.step
        count = np.maximum(1, -(-(sizes - overlap) // self.step))
        rows = np.repeat(np.arange(len(sizes)), count)
        return rows, (np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)) * self.step

    def fill(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The bytes of windows, with zeros after the end of a text. ``data`` needs ``window`` spare bytes at its end."""
        at = offsets[rows] + starts
        out = np.lib.stride_tricks.sliding_window_view(data, self.window)[at]
        left = offsets[rows + 1] - at
        short = np.flatnonzero(left < self.window)
        out[short] *= np.arange(self.window) < left[short, None]
        return out

    def _sums(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        parts = self.embed[windows].reshape(-1, self.unit * self.depth)
        z = (parts @ self.weights).reshape(len(windows), self.places, -1)
        sums, at = [], 0
        for width, filters in self.banks:
            total = z[:, : self.places - width + 1, at : at + filters]
            for j in range(1, width):
                at += filters
                total = total + z[:, j : self.places - width + 1 + j, at : at + filters]
            at += filters
            sums.append(total)
        return parts, sums

    def features(self, windows: np.ndarray) -> np.ndarray:
        """Maximum of every filter over each window, cut off at zero."""
        _, sums = self._sums(windows)
        return np.maximum(np.concatenate([s.max(1) for s in sums], 1) + self.bias, 0)

    def slabs(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, bytes, features) of all windows of a batch of texts, some windows at a time."""
        padded = np.concatenate([data[offsets[0] : offsets[-1]], np.zeros(self.window, np.uint8)])
        offsets = offsets - offsets[0]
        rows, starts = self.cut(np.diff(offsets))
        for at in range(0, len(rows), SLAB):
            r, s = rows[at : at + SLAB], starts[at : at + SLAB]
            yield r, np.minimum(offsets[r + 1] - offsets[r] - s, self.window), self.features(self.fill(padded, offsets, r, s))

    def learn(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Features, and what ``gradients`` needs."""
        parts, sums = self._sums(windows)
        best = [s.argmax(1) for s in sums]
        top = np.concatenate([np.take_along_axis(s, b[:, None], 1)[:, 0] for s, b in zip(sums, best)], 1) + self.bias
        return np.maximum(top, 0), (windows, parts, best, top)

    def gradients(self, kept: tuple, slope: np.ndarray) -> list[np.ndarray]:
        windows, parts, best, top = kept
        slope = slope * (top > 0)
        embed, weights = np.zeros_like(self.embed), np.zeros_like(self.weights)
        at = first = 0
        for (width, filters), place in zip(self.banks, best):
            part = slope[:, first : first + filters]
            for j in range(width):
                rows = np.arange(len(windows))[:, None] * self.places + place + j
                weights[:, at : at + filters] = np.einsum("nfc,nf->cf", parts[rows], part, optimize=True)
                back = part[..., None] * self.weights[:, at : at + filters].T
                letters = windows[np.arange(len(windows))[:, None, None], ((place + j) * self.unit)[..., None] + np.arange(self.unit)]
                np.add.at(embed, letters.ravel(), back.reshape(-1, self.depth))
                at += filters
            first += filters
        embed[0] = 0
        return [embed, weights, slope.sum(0)]


class Adam:
    def __init__(self, parameters: list[np.ndarray], rate: float = 0.004):
        self.parameters, self.rate, self.t = parameters, rate, 0
        self.m = [np.zeros_like(p) for p in parameters]
        self.v = [np.zeros_like(p) for p in parameters]

    def step(self, gradients: list[np.ndarray], scale: float = 1.0) -> None:
        self.t += 1
        for p, g, m, v in zip(self.parameters, gradients, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (scale * self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-7)).astype(p.dtype)
