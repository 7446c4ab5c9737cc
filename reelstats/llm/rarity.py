"""A fixed-size frequency table of hashes, and the rare-to-frequent order that it gives.

Tasks count all their hashes into COUNTERS counters, ship them compressed in
segments, and the merged table (16 bits a counter, 8 MiB whatever the input) is
broadcast. Sharing a counter only disturbs the order; any order that all tasks
share gives right results, a good one keeps frequent hashes from being chosen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reelstats.llm.arrowtext import U64, mix

COUNTERS = 1 << 22
SEGMENTS = 16
_STEP = COUNTERS // SEGMENTS


def count(table: np.ndarray, hashes: np.ndarray) -> None:
    np.add.at(table, (hashes & U64(COUNTERS - 1)).astype(np.int64), 1)


def packed(table: np.ndarray) -> list[bytes]:
    return [zlib.compress(table[i * _STEP : (i + 1) * _STEP].astype(np.uint32).tobytes(), 1) for i in range(SEGMENTS)]


def merged(parts: DataFrame) -> np.ndarray:
    """Frequency classes of the counters, from rows (segment long, counts binary)."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_STEP, np.int64)
        for batch in batches:
            for x in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
        classes = np.floor(np.log2(total + 1) * 1024).astype(np.uint16)
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([classes.tobytes()], pa.binary())], names=["segment", "counts"])

    out = np.zeros(COUNTERS, np.uint16)
    for r in parts.groupBy("segment").applyInArrow(run, "segment long, counts binary").toLocalIterator():  # SEGMENTS rows
        out[r["segment"] * _STEP : (r["segment"] + 1) * _STEP] = np.frombuffer(r["counts"], np.uint16)
    return out


def codes(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Hashes as numbers that sort from rare to frequent: 16 bits of class, 48 of the hash."""
    return (classes[(hashes & U64(COUNTERS - 1)).astype(np.int64)].astype(U64) << U64(48)) | (mix(hashes) >> U64(16))
