"""Vectorized word and shingle hashing over Arrow batches (helpers of the operators).

Texts are handled as UTF-8 bytes of a whole Arrow column at once.  Word hashes
are 64-bit polynomial hashes of the word's bytes, mixed; they are the same on
every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 20          # text bytes handled at a time
_P = 0x9E3779B97F4A7C15 | 1    # odd multiplier of the polynomial
_PINV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective) over an array."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(U(seed) * U(0xD1342543DE82EF95) + np.arange(1, n + 1, dtype=U) * U(_P))


_BYTE = stream(1, 256)
_STEP = stream(2, 64) | U(1)   # multipliers of the words of a shingle, by position
_pow = {"p": np.ones(1, U), "q": np.ones(1, U)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of the bytes outside white space 0x20, 0x09-0x0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of digits, ASCII letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["p"]) < n:
        for key, base in (("p", _P), ("q", _PINV)):
            a = np.full(n, base, U)
            a[0] = 1
            _pow[key] = np.multiply.accumulate(a)
    return _pow["p"], _pow["q"]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of an Arrow string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(batches, column: str = "text", most: int = CHUNK_BYTES):
    """Slices of the batches holding at most ``most`` text bytes, or one row if that has more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(off, off[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


class Words:
    """The words of the rows of one string column.

    ``first`` has, for each row, the index of its first word (and the total at
    the end); ``start``/``end`` are byte positions in ``raw``; ``hash`` are the
    words' hashes.
    """

    def __init__(self, column, kind: np.ndarray = SPACED, lower: bool = True):
        raw, off = utf8(column)
        self.raw = raw = LOWER[raw] if lower else raw
        inside = kind[raw] if len(raw) else np.zeros(0, bool)
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        before[off[:-1][off[:-1] < len(raw)]] = False
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        cut = off[1:][off[1:] > 0] - 1
        after[cut] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.hash = np.empty(len(self.start), U)
        i = 0
        while i < len(self.start):  # bounded memory, also within one very long row
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + CHUNK_BYTES, "right")))
            s0 = self.start[i]
            seg = raw[s0:self.end[j - 1]]
            p, q = _powers(len(seg) + 1)
            total = np.zeros(len(seg) + 1, U)
            np.cumsum(_BYTE[seg] * p[:len(seg)], out=total[1:])
            a, b = self.start[i:j] - s0, self.end[i:j] - s0
            self.hash[i:j] = mix((total[b] - total[a]) * q[a] + (b - a).astype(U))
            i = j

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]].tobytes()


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (whatever rows they are in)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, U)
    total = np.full(m, n, U)
    for k in range(n):
        total += hashes[k:k + m] * _STEP[k]
    return mix(total)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct ``n``-word shingles, sorted: (flat hashes, row offsets).

    A row of fewer than ``n`` words, but not none, has its whole sequence as
    its only shingle.
    """
    runs, out, sizes = combine(words.hash, n), [], np.zeros(len(words) + 1, np.int64)
    for d in range(len(words)):
        a, b = int(words.first[d]), int(words.first[d + 1])
        if b - a >= n:
            own = np.unique(runs[a:b - n + 1])
        elif b > a:
            own = combine(words.hash[a:b], b - a)
        else:
            own = np.empty(0, U)
        out.append(own)
        sizes[d + 1] = len(own)
    return (np.concatenate(out) if out else np.empty(0, U)), np.cumsum(sizes)


def lists(flat: np.ndarray, offsets: np.ndarray, kind) -> pa.Array:
    """An Arrow list column from a flat array and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
