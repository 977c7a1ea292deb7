"""Count-min sketches with one byte a cell, filled by tasks and added up over all of them.

Cells stop at a limit, up to which they never underestimate.  A sketch has a bounded
size, is collected and broadcast, and only tells what cannot reach the limit: what
it lets pass is counted exactly by whoever uses it, so its size changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from kgspark.llm import text as tx

U64 = np.uint64
#: the least cells of a row; a sketch moves in parts of so many cells
PART = 1 << 16
SCHEMA = "part int, cells binary"


def width_for(things: int, most: int) -> int:
    """Cells of a row for so many distinct things, about: a power of two, `most` at most."""
    return min(most, max(PART, 1 << int(things).bit_length()))


def cells(h: np.ndarray, row: int, width: int) -> np.ndarray:
    """The cell of each 64-bit hash in one row."""
    return tx.mix(h + U64(row + 1)) & U64(width - 1)


class Sketch:
    """A task's own counts, in one row or in several of different hashes."""

    def __init__(self, width: int, full: int, rows: int):
        self.width, self.full, self.table = width, full, np.zeros((rows, width), np.uint8)

    def add(self, row: int, cell: np.ndarray, n: np.ndarray) -> None:
        """Add n[i] to cell[i]; a cell is given once."""
        self.table[row, cell] = np.minimum(self.full, self.table[row, cell] + n)

    def add_hashes(self, h: np.ndarray, n: np.ndarray) -> None:
        """Add n[i] for h[i] to each row; hashes may repeat or share cells."""
        for row in range(len(self.table)):
            cell, at = np.unique(cells(h, row, self.width), return_inverse=True)
            self.add(row, cell, np.bincount(at, n))

    def parts(self) -> Iterator[pa.RecordBatch]:
        """The parts that have a count, as rows (part, cells)."""
        parts = self.table.reshape(-1, min(PART, self.width))
        for part in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "cells": [zstandard.compress(parts[part].tobytes(), 1)]})


def _added(full: int):
    """Rows in order of their part, added up to one row for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        row = lambda: pa.RecordBatch.from_pydict({"part": pa.array([last], pa.int32()), "cells": [zstandard.compress(total.tobytes(), 1)]})
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = np.frombuffer(zstandard.decompress(packed.as_py()), np.uint8)
                if part != last:
                    if last is not None:
                        yield row()
                    last, total = part, one
                else:
                    total = np.minimum(full, total.astype(np.uint16) + one).astype(np.uint8)
        if last is not None:
            yield row()

    return run


def merged(made: DataFrame, width: int, full: int, rows: int) -> np.ndarray:
    """The sum of all tasks' parts (part, cells) as a table of `rows` rows."""
    size = min(PART, width)
    table = np.zeros((rows * width // size, size), np.uint8)
    for r in made.repartition("part").sortWithinPartitions("part").mapInArrow(_added(full), SCHEMA).collect():
        table[r["part"]] = np.frombuffer(zstandard.decompress(bytes(r["cells"])), np.uint8)
    return table.reshape(rows, width)


def passes(table: np.ndarray, h: np.ndarray, full: int) -> np.ndarray:
    """Whether each hash may have a count of `full`."""
    may = np.ones(len(h), bool)
    for row in range(len(table)):
        may &= table[row, cells(h, row, table.shape[1])] >= full
    return may
