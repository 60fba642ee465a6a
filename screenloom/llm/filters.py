"""Sets of 64-bit hashes of bounded size that tasks filter their rows with."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Up to so many hashes are handed to the tasks as a list (8 bytes each); more are handed to them
#: as 2^BITS bits, some of which let a row pass that a join then drops.
MOST, BITS = 2_000_000, 27


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


@dataclass(frozen=True)
class Filter:
    """A set of 64-bit hashes, exact as a sorted list or with false hits as bits."""

    ordered: np.ndarray | None = None
    bits: np.ndarray | None = None

    def has(self, values: np.ndarray) -> np.ndarray:
        if self.ordered is not None:
            return member(values, self.ordered)
        at = values & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def filter_of(hashes: DataFrame) -> Filter:
    """A filter for the distinct hashes in the one column of ``hashes``. Bits are set in the tasks,
    page by page, and the pages of all tasks united."""
    if hashes.limit(MOST + 1).count() <= MOST:
        return Filter(ordered=np.sort(hashes.toArrow().column(0).to_numpy().view(np.uint64)))
    size = 1 << max(0, BITS - 3)
    page = min(size, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) & np.uint64(8 * size - 1)
            np.bitwise_or.at(own, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        for k in range(0, size, page):
            if own[k : k + page].any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([own[k : k + page].tobytes()])], names=["k", "b"])

    def unite(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(page, np.uint8)
        for batch in batches:
            for b in batch.column("b").to_pylist():
                out |= np.frombuffer(b, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([out.tobytes()])], names=["k", "b"])

    pages = hashes.mapInArrow(run, "k long, b binary").groupBy("k").applyInArrow(unite, "k long, b binary")
    out = np.zeros(size, np.uint8)
    for row in pages.toArrow().to_pylist():
        out[row["k"] : row["k"] + page] = np.frombuffer(row["b"], np.uint8)
    return Filter(bits=out)
