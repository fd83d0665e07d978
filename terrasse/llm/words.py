"""Words, hashes and window hashes of Arrow text columns, as flat numpy arrays.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``.  All functions work on whole rows; `slices`
bounds how much text is in hand at once without ever cutting a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
SPACES = b" \t\n\x0b\x0c\r"


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = np.cumsum(size + 16) // limit
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def plain(texts: pa.Array) -> pa.Array:
    """NULL as empty text, in an array without an offset."""
    return pa.concat_arrays([pc.fill_null(texts.cast(pa.string()), "")])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a `plain` column and where each row starts and the last one ends."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8))[: ends[-1]], ends


def count_bytes(texts: pa.Array, wanted: np.ndarray) -> np.ndarray:
    """Per row, the number of bytes that a table of 256 truth values holds."""
    data, ends = text_bytes(texts)
    return np.diff(np.concatenate(([0], np.cumsum(wanted[data], dtype=np.int64)))[ends])


@dataclass
class Words:
    """Words of row ``i``: ``ids[starts[i]:starts[i + 1]]``, indexes into ``vocab``."""

    starts: np.ndarray
    ids: np.ndarray
    vocab: list[bytes]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        table = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.vocab), np.uint64, len(self.vocab))
        return table[self.ids]


def split_words(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(plain(texts))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    starts = np.concatenate(([0], np.cumsum(real, dtype=np.int64)))[offsets - offsets[0]]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    return Words(starts, coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist())


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D)  # odd, so that both have an inverse modulo 2^64


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))), dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        _POWERS[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(starts: np.ndarray, length: int) -> np.ndarray:
    """Flat positions at which ``length`` consecutive words of one row start."""
    counts = np.maximum(np.diff(starts) - length + 1, 0)
    before = np.cumsum(counts) - counts
    return np.repeat(starts[:-1] - before, counts) + np.arange(counts.sum())


def rolling(hashes: np.ndarray, at: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of the ``length`` words from each flat position on."""
    if not len(at):
        return np.empty(0, np.uint64)
    power, inverse = _powers(base, len(hashes))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64)))
    return mix((sums[at + length] - sums[at]) * inverse[at])


def runs_of(counts: np.ndarray) -> np.ndarray:
    """0, 1, … within each of consecutive runs of the given lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
