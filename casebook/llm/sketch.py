"""Cell arrays built by all tasks: count-min sketches and bit sets whose size follows a count.

A task hashes its values to cells and sends, for each block of 65,536 cells, the
places it has hit with their counts. Blocks meet by number in a shuffle, so
what is sent follows the values, not tasks times cells, and the driver receives
the array once. The number of cells is a power of two chosen from the number
of values and bounded; a fuller array errs towards "more" and "contained",
which its users check exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casebook.llm.words import mix

BLOCK_BITS = 16
SEEN = 255                           # counts stop here


def cells_for(values: int, each: int, low: int, high: int) -> int:
    """Log2 of the number of cells: at least ``each`` a value, between ``low`` and ``high`` bits."""
    return min(high, max(low, int(values * each).bit_length()))


def cell_counts(df: DataFrame, cells_of, bits: int) -> np.ndarray:
    """How often each of the 2**bits cells is hit (at most SEEN); ``cells_of(batch)`` gives the cells of a batch."""
    size = 1 << min(BLOCK_BITS, bits)

    def find(batches):
        for b in batches:
            cells, n = np.unique(np.asarray(cells_of(b), np.int64), return_counts=True)
            n = np.minimum(n, SEEN).astype(np.uint8)
            cut = np.flatnonzero(np.diff(cells // size)) + 1
            if len(cells):
                parts = [(int(c[0]) // size, (c % size).astype("<u2").tobytes(), k.tobytes()) for c, k in zip(np.split(cells, cut), np.split(n, cut))]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int64()), pa.array([p[1] for p in parts], pa.binary()),
                                                  pa.array([p[2] for p in parts], pa.binary())], ["block", "places", "counts"])

    def join(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, places, counts in zip(b.column("block").to_pylist(), b.column("places").to_pylist(), b.column("counts").to_pylist()):
                block = held.setdefault(k, np.zeros(size, np.uint8))
                at = np.frombuffer(places, "<u2")
                block[at] = np.minimum(block[at].astype(np.int64) + np.frombuffer(counts, np.uint8), SEEN)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["block", "data"])

    found = df.mapInArrow(find, "block long, places binary, counts binary")
    out = np.zeros(1 << bits, np.uint8)
    for r in found.repartition("block").mapInArrow(join, "block long, data binary").toLocalIterator():
        out[r["block"] * size:(r["block"] + 1) * size] = np.frombuffer(r["data"], np.uint8)
    return out


def row_cells(h: np.ndarray, rows: int, bits: int) -> np.ndarray:
    """Cells of the hashes in each of the sketch's rows (rows x hashes); row r takes the cells from r * 2**bits on."""
    return np.stack([(mix(h + np.uint64((r * 0x9E3779B97F4A7C15) & (2**64 - 1))) >> np.uint64(64 - bits)).astype(np.int64) + (r << bits) for r in range(rows)])


class CountMin:
    """Counts of hashed values that are never too low: the least of a value's cells."""

    ROWS = 2

    def __init__(self, df: DataFrame, hash_of, bits: int):
        rows, self.bits = self.ROWS, bits
        self.cells = cell_counts(df, lambda b: row_cells(hash_of(b), rows, bits).ravel(), bits + (rows - 1).bit_length())

    def estimate(self, h: np.ndarray) -> np.ndarray:
        return self.cells[row_cells(h, self.ROWS, self.bits)].min(axis=0)


class Bits:
    """A set of hashes that may hold a few more than were put in."""

    def __init__(self, df: DataFrame, hash_of, bits: int):
        self.bits = bits
        self.packed = np.packbits(cell_counts(df, lambda b: row_cells(hash_of(b), 1, bits)[0], bits) > 0, bitorder="little")

    def holds(self, h: np.ndarray) -> np.ndarray:
        at = row_cells(h, 1, self.bits)[0]
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
