"""Words, hashes and runs of whole texts, computed for many texts at once on their UTF-8 bytes.

Null texts count as empty everywhere. Work goes through blocks of a fixed number of bytes, so
the memory needed beside the texts themselves does not grow with a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
FACTOR = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse, modulo 2**64."""
    out = []
    for f in (factor, pow(factor, -1, 1 << 64)):
        p = np.full(n, f, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows (a null row is empty)."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


class Splitter:
    """Splits texts into words and hashes them; one instance per task.

    A word is a run of bytes outside ``separators``; A-Z count as a-z. With ``letters_only`` a word
    is a run of ASCII letters, digits, and bytes of other scripts.
    """

    def __init__(self, letters_only: bool = False) -> None:
        code = np.arange(256)
        blank = (code == 32) | ((code >= 9) & (code <= 13))
        alnum = ((code >= 48) & (code <= 57)) | ((code | 32) >= 97) & ((code | 32) <= 122) | (code >= 128)
        self.separator = ~alnum if letters_only else blank
        self.lower = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint64) + np.uint64(1)
        self.power, self.inverse = powers(FACTOR, BLOCK)

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = int(np.searchsorted(ends, starts[i] + BLOCK - 1, "right"))
            if j <= i:  # one word longer than a block: the same polynomial, piece by piece
                total, scale = np.uint64(0), np.uint64(1)
                for at in range(int(starts[i]), int(ends[i]), BLOCK - 1):
                    part = self.lower[data[at:min(at + BLOCK - 1, int(ends[i]))]]
                    total = total + scale * np.sum(part * self.power[:len(part)], dtype=np.uint64)
                    scale = scale * self.power[BLOCK - 1]
                out[i] = total
                i += 1
                continue
            base = int(starts[i])
            part = self.lower[data[base:int(ends[j - 1])]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * self.power[:len(part)], out=sums[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * self.inverse[s]
            i = j
        return mix(out)

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of every word, and the n + 1 positions where each row's words begin."""
        n = len(data)
        if not n:
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        gap = self.separator[data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner], after[inner - 1] = True, True
        starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
        with np.errstate(over="ignore"):
            hashes = self._hashes(data, starts, ends)
        return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each row, and the n + 1 positions of the rows' runs.

    A row with fewer words has its whole sequence as one run, a row without words none.
    """
    counts = np.diff(rows)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    at = np.concatenate([[0], np.cumsum(runs)])
    factors, _ = powers(0xD1342543DE82EF95, size + 1)
    with np.errstate(over="ignore"):
        padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
        total = np.zeros(len(hashes), np.uint64)
        for j in range(size):
            total += padded[j:j + len(hashes)] * factors[j]
        first = np.repeat(rows[:-1] - at[:-1], runs) + np.arange(at[-1])
        out = total[first]
        for row in np.flatnonzero((counts > 0) & (counts < size)):
            words = hashes[rows[row]:rows[row + 1]]
            out[at[row]] = np.sum(words * factors[:len(words)], dtype=np.uint64) + np.uint64(len(words)) * factors[size]
        return mix(out), at
