"""A Bloom filter of bounded size over 64-bit hashes, built on the executors in segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 1 << 22  # 32 MB; beyond it the filter lets more through and nothing else changes
BITS_PER_KEY = 16
_SEGMENTS = 64


class Bloom:
    """Each key sets four bits of one 64-bit word."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) - 1)

    @staticmethod
    def pattern(h: np.ndarray) -> np.ndarray:
        one, six, low = np.uint64(1), np.uint64(63), np.zeros(len(h), np.uint64)
        for shift in (58, 52, 46, 40):
            low |= one << ((h >> np.uint64(shift)) & six)
        return low

    def add(self, h: np.ndarray) -> None:
        np.bitwise_or.at(self.words, (h & self.mask).astype(np.int64), self.pattern(h))

    def contains(self, h: np.ndarray) -> np.ndarray:
        want = self.pattern(h)
        return (self.words[(h & self.mask).astype(np.int64)] & want) == want


def words_for(keys: int) -> int:
    return int(min(MAX_WORDS, max(1 << 12, 1 << int(keys * BITS_PER_KEY / 64).bit_length())))


def build(hashes: DataFrame, keys: int) -> Broadcast:
    """A broadcast filter of the column ``h`` (long) sized for about ``keys`` values.

    Hashes go to the segment of the filter that they touch, a task fills its segments, and the
    segments (``MAX_WORDS`` words together) meet on the driver.
    """
    n = words_for(keys)
    width = n // _SEGMENTS
    spark = hashes.sparkSession
    placed = hashes.select("h", F.floor(F.col("h").bitwiseAND(F.lit(n - 1)) / width).cast("int").alias("segment")).repartition(_SEGMENTS, "segment")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            h, at = batch.column("h").to_numpy().view(np.uint64), batch.column("segment").to_numpy()
            for s in np.unique(at).tolist():
                words = held.setdefault(s, np.zeros(width, np.uint64))
                mine = h[at == s]
                np.bitwise_or.at(words, ((mine & np.uint64(n - 1)) - np.uint64(s * width)).astype(np.int64), Bloom.pattern(mine))
        for s, words in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([words.tobytes()], pa.binary())], names=["segment", "words"])

    whole = np.zeros(n, np.uint64)
    for row in placed.mapInArrow(fill, "segment int, words binary").toLocalIterator():
        whole[row["segment"] * width : (row["segment"] + 1) * width] = np.frombuffer(row["words"], np.uint64)
    return spark.sparkContext.broadcast(Bloom(whole))
