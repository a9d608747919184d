"""A bounded count-min sketch of 64-bit keys, with counters that stop at two.

Every task turns its keys into cells and sends, per block of cells, the cells it
has met once and more often (two bytes a cell); tasks add these up block by block,
and the driver lays the packed blocks side by side: 2 bits a cell, at most
2 * HASHES * 2 ** MAX_BITS bits, however many keys there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loglens.llm.text import U, mix, stream

HASHES = 2
MIN_BITS, MAX_BITS = 16, 26   # of the number of cells per hash
BLOCK_BITS = 13
FLUSH = 1 << 20               # keys that a task holds


def bits_for(keys: int) -> int:
    """Four cells a key or more, within the bounds."""
    return max(MIN_BITS, min(MAX_BITS, int(4 * keys).bit_length()))


def cells(keys: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    """The cell of each key under each hash."""
    return [(mix(keys ^ seed) >> U(64 - bits)).astype(np.int64) for seed in stream(31, hashes)]


class Sketch:
    """``once`` and ``twice``: packed bits per hash, whether a cell has been met at least so often."""

    def __init__(self, once: np.ndarray, twice: np.ndarray, bits: int):
        self.once, self.twice, self.bits = once, twice, bits

    def _all(self, flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for own, at in zip(flags, cells(keys, self.bits, len(flags))):
            out &= (own[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out

    def met(self, keys: np.ndarray) -> np.ndarray:
        """False proves that a key was never added."""
        return self._all(self.once, keys)

    def met_twice(self, keys: np.ndarray) -> np.ndarray:
        """False proves that a key was added at most once."""
        return self._all(self.twice, keys)


def mark_bits(keys: int) -> int:
    """How many leading bits of a mark name the block that it is counted in: some ``2 ** 18`` keys each."""
    return max(4, min(24, int(keys).bit_length() - 18))


def marks(keys: np.ndarray, bits: int) -> np.ndarray:
    """What stands for keys among ``2 ** bits`` times ``2 ** 18`` of them: ``bits + 32`` bits, so one in some ten thousand meets another's."""
    return mix(keys ^ stream(37, 1)[0]) >> U(32 - bits)


def repeated(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """(mark) of the bigint column ``key`` (no nulls) met twice or more, each once.

    Unlike a sketch's, its share of false ones doesn't depend on the number of keys: tasks
    send the marks themselves (four bytes each), by blocks of their leading bits.
    """
    def part(batches):
        held, n = [], 0

        def flush():
            mark, count = np.unique(marks(np.concatenate(held), bits), return_counts=True)
            block, low = (mark >> U(32)).astype(np.int64), mark.astype(np.uint32)
            start = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
            ends = [*start[1:], len(mark)]
            return pa.RecordBatch.from_arrays([pa.array(block[start], pa.int32()), pa.array([low[i:j].tobytes() for i, j in zip(start, ends)], pa.binary()),
                                               pa.array([low[i:j][count[i:j] > 1].tobytes() for i, j in zip(start, ends)], pa.binary())], ["block", "once", "twice"])

        for batch in batches:
            held.append(batch.column(key).to_numpy().view(U))
            n += batch.num_rows
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def merge(batches):
        now, held = None, []

        def done():
            low, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(low[count > 1].astype(np.int64) | now << 32, pa.int64())], ["mark"])

        for batch in batches:
            for block, once, twice in zip(batch.column("block").to_pylist(), batch.column("once"), batch.column("twice")):
                if block != now:
                    if held:
                        yield done()
                    now, held = block, []
                held += [np.frombuffer(x.as_buffer(), np.uint32) for x in (once, twice) if len(x.as_buffer())]
        if held:
            yield done()

    sent = rows.select(key).mapInArrow(part, "block int, once binary, twice binary")
    return sent.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "mark bigint")


def build(rows: DataFrame, key: str, bits: int, hashes: int = HASHES) -> Sketch:
    """The sketch of the bigint column ``key`` (no nulls)."""
    blocks = 1 << (bits - BLOCK_BITS)

    def part(batches):
        held, n = [], 0

        def flush():
            keys = np.concatenate(held)
            block, once, twice = [], [], []
            for k, at in enumerate(cells(keys, bits, hashes)):
                cell, count = np.unique(at, return_counts=True)
                b = cell >> BLOCK_BITS
                start = np.flatnonzero(np.diff(b, prepend=-1))
                low = (cell & ((1 << BLOCK_BITS) - 1)).astype(np.uint16)
                for i, j in zip(start.tolist(), np.append(start[1:], len(b)).tolist()):
                    block.append(k * blocks + int(b[i]))
                    once.append(low[i:j].tobytes())
                    twice.append(low[i:j][count[i:j] > 1].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["block", "once", "twice"])

        for batch in batches:
            held.append(batch.column(key).to_numpy().view(U))
            n += batch.num_rows
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def merge(batches):
        now, count = None, None

        def done():
            pack = lambda x: pa.array([np.packbits(x, bitorder="little").tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pack(count > 0), pack(count > 1)], ["block", "once", "twice"])

        for batch in batches:
            for block, once, twice in zip(batch.column("block").to_pylist(), batch.column("once"), batch.column("twice")):
                if block != now:
                    if now is not None:
                        yield done()
                    now, count = block, np.zeros(1 << BLOCK_BITS, np.uint8)
                for cell in (once, twice):
                    at = np.frombuffer(cell.as_buffer(), np.uint16)
                    count[at] = np.minimum(count[at] + 1, 2)
        if now is not None:
            yield done()

    schema = "block int, once binary, twice binary"
    sent = rows.select(key).mapInArrow(part, schema)
    got = sent.repartition("block").sortWithinPartitions("block").mapInArrow(merge, schema).toArrow()
    width = 1 << (BLOCK_BITS - 3)
    flags = np.zeros((2, hashes * blocks, width), np.uint8)
    for k, name in enumerate(("once", "twice")):
        for block, x in zip(got.column("block").to_pylist(), got.column(name)):
            flags[k, block] = np.frombuffer(x.as_buffer(), np.uint8)
    return Sketch(*flags.reshape(2, hashes, blocks * width), bits)
