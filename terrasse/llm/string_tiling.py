"""Benchmark decontamination by greedy string tiling.

Tokens are words in lower case without punctuation at their ends.  Runs of ``MIN_MATCH`` tokens
of the benchmark items are seeds; every such run of every document is looked up among them.  A
pair that shares seeds is tiled by running Karp-Rabin: matches of a search length are found by
rolling hashes, checked token by token, and marked longest first without overlap; the length then
falls to ``MIN_MATCH``.  The tiles may lie in any order, so a passage whose parts were moved about
is covered as well as one in place.  A document holds an item whose tiles cover at least
``COVERAGE`` of its tokens.

The benchmark is a stated query set: it is read in blocks of ``BLOCK_TOKENS`` tokens, and each
block meets all documents in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasse.llm.words import rolling, slices, split_words, windows

MIN_MATCH, COVERAGE, BLOCK_TOKENS = 4, 0.5, 1 << 20
BREAK = np.uint64(0)  # no token has this hash, see `tokens`


def _bare(word: bytes) -> bytes:
    text = word.decode("utf-8", "replace").lower()
    a, b = 0, len(text)
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return text[a:b].encode()


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's tokens start, and the 64-bit hash of each token."""
    words = split_words(texts)
    bare = [_bare(w) for w in words.vocab]
    real = np.array([bool(b) for b in bare], bool)[words.ids] if bare else np.zeros(0, bool)
    table = np.fromiter((xxhash.xxh64_intdigest(b) or 1 for b in bare), np.uint64, len(bare))
    starts = np.concatenate(([0], np.cumsum(real)))[words.starts]
    return starts, table[words.ids[real]]


def matches(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal equal runs ``(length, i, j)`` of at least ``size`` unmarked tokens, longest first."""
    found = []
    for free in (free_a, free_b):
        total = np.concatenate(([0], np.cumsum(free)))
        found.append(np.flatnonzero(total[size:] - total[:-size] == size) if len(free) >= size else np.zeros(0, np.int64))
    at_a, at_b = found
    if not len(at_a) or not len(at_b):
        return []
    ha, hb = rolling(a, at_a, size), rolling(b, at_b, size)
    order = np.argsort(ha, kind="stable")
    low, high = np.searchsorted(ha[order], hb, "left"), np.searchsorted(ha[order], hb, "right")
    n = high - low
    i = at_a[order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]]
    j = np.repeat(at_b, n)
    same = np.ones(len(i), bool)
    for t in range(size):  # a hash is only a hint
        same &= a[i + t] == b[j + t]
    i, j = i[same], j[same]
    if not len(i):
        return []
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(i) != 1) | (np.diff(j) != 1))))
    length = np.diff(np.append(first, len(i))) + size - 1
    rows = np.lexsort((j[first], i[first], -length))
    return list(zip(length[rows].tolist(), i[first][rows].tolist(), j[first][rows].tolist(), strict=True))


def greedy_tiles(a: np.ndarray, b: np.ndarray, size: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles ``(length, i, j)``: again and again the longest unmarked match, ties by ``i`` then ``j``."""
    free_a, free_b, tiles = np.ones(len(a), bool), np.ones(len(b), bool), []
    search = max(size, min(len(a), len(b)))
    while True:
        again = False
        for length, i, j in matches(a, b, free_a, free_b, search):
            if free_a[i : i + length].all() and free_b[j : j + length].all():
                free_a[i : i + length] = free_b[j : j + length] = False
                tiles.append((length, i, j))
            elif not again:
                again = True  # what is left of it may be shorter than a later match, so look anew
                break
        if again:
            continue
        if search == size:
            return tiles
        search = max(size, search // 2)


PERIODS = 16


def _covered(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` places the windows of ``size`` from ``at`` on cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(b: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``b`` with each stretch of tokens that are gone replaced by one token of no item."""
    first = gone & ~np.concatenate(([False], gone[:-1]))
    return np.where(first, BREAK, b)[~gone | first]


def essential(a: np.ndarray, b: np.ndarray, size: int = MIN_MATCH) -> np.ndarray:
    """A text ``b`` as short as the greedy search for tiles with ``a`` allows, with the same tiles in the same order.

    Tokens in no window that ``a`` has too are in no match: a stretch of them becomes one break.  Where a text repeats with a period
    of up to ``PERIODS`` tokens, a match is found as well a period earlier, and the search takes the earliest; all tiles together
    are no longer than ``a``.  So of a long repetition only the beginning is of use, and the end, which matches may leave.
    Junk of one word a million times is then no more work than a page of it.
    """
    at = windows(np.array([0, len(b)]), size)
    if not len(at) or len(a) < size:
        return b[:0]
    shared = np.isin(rolling(b, at, size), rolling(a, windows(np.array([0, len(a)]), size), size))
    b = _cut(b, ~_covered(at[shared], size, len(b)))
    for period in range(1, PERIODS + 1):
        keep = len(a) * (4 + period) + 2 * period
        if len(b) <= 2 * keep + period:
            break
        same = np.concatenate(([0], (b[period:] == b[:-period]).astype(np.int8), [0]))
        rise = np.diff(same)
        gone = np.zeros(len(b), bool)
        for x, y in zip(np.flatnonzero(rise == 1), np.flatnonzero(rise == -1) + period, strict=True):
            if y - x > 2 * keep + period:
                gone[x + keep : y - keep] = True
        if gone.any():
            b = _cut(b, gone)
    return b


@dataclass
class Items:
    """A block of benchmark items and its seeds, sorted by hash.

    Items of fewer than ``size`` tokens have no seed; they are in ``short`` and have to be found whole.
    """

    ids: list
    tokens: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    at: np.ndarray
    size: int
    short: dict[int, list[int]]  # number of tokens -> items

    @classmethod
    def of(cls, ids: list, texts: list, size: int) -> Items:
        starts, h = tokens(pa.array(texts, pa.string()))
        at = windows(starts, size)
        row = np.searchsorted(starts, at, "right") - 1
        seeds = rolling(h, at, size)
        order = np.argsort(seeds, kind="stable")
        items = [h[x:y] for x, y in zip(starts[:-1], starts[1:], strict=True)]
        short: dict[int, list[int]] = {}
        for i, t in enumerate(items):
            if 0 < len(t) < size:
                short.setdefault(len(t), []).append(i)
        return cls(ids, items, seeds[order], row[order], (at - starts[row])[order], size, short)

    def whole_in(self, starts: np.ndarray, h: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Short items that stand in a row as they are."""
        out = []
        for n, items in self.short.items():
            at = windows(starts, n)
            grams = np.stack([h[at + k] for k in range(n)], axis=1) if len(at) else np.empty((0, n), np.uint64)
            for i in items:
                hit = at[(grams == self.tokens[i]).all(axis=1)]
                out += [(int(r), i, n, 1, n) for r in np.unique(np.searchsorted(starts, hit, "right") - 1)]
        return out

    def found_in(self, texts: pa.Array, coverage: float) -> list[tuple[int, int, int, int, int]]:
        """``(row, item, covered tokens, tiles, longest tile)`` of all pairs that reach the coverage."""
        starts, h = tokens(texts)
        out, at = self.whole_in(starts, h), windows(starts, self.size)
        if not len(at) or not len(self.seeds):
            return out
        probe = rolling(h, at, self.size)
        rough = np.zeros(1 << 22, bool)
        rough[(self.seeds & np.uint64(len(rough) - 1)).astype(np.int64)] = True
        some = np.flatnonzero(rough[(probe & np.uint64(len(rough) - 1)).astype(np.int64)])
        # What repeats within a row is looked up once: only what it covers of an item counts here.
        once = np.unique(np.stack((np.searchsorted(starts, at[some], "right").astype(np.uint64) - np.uint64(1), probe[some])), axis=1)
        of, probe = once[0].astype(np.int64), once[1]
        low, high = np.searchsorted(self.seeds, probe, "left"), np.searchsorted(self.seeds, probe, "right")
        n = high - low
        if not n.sum():
            return out
        place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        row = np.repeat(of, n)
        # Tiles lie within shared seeds, so the item tokens that shared seeds cover bound the coverage.
        triple = np.unique(np.stack((row, self.item[place], self.at[place])), axis=1)
        pair = np.flatnonzero(np.concatenate(([True], (np.diff(triple[0]) != 0) | (np.diff(triple[1]) != 0))))
        for x, y in zip(pair, np.append(pair[1:], triple.shape[1]), strict=True):
            r, item = int(triple[0, x]), int(triple[1, x])
            a = self.tokens[item]
            if _covered(triple[2, x:y], self.size, len(a)).sum() < coverage * len(a):
                continue
            tiles = greedy_tiles(a, essential(a, h[starts[r] : starts[r + 1]], self.size), self.size)
            covered = sum(t[0] for t in tiles)
            if covered >= coverage * len(a):
                out.append((r, item, covered, len(tiles), max(t[0] for t in tiles)))
        return out


def benchmark_blocks(benchmark: DataFrame, size: int = MIN_MATCH, key: str = "item_id", text: str = "text", limit: int = BLOCK_TOKENS) -> Iterator[Items]:
    """All items, some at a time; items without a token, such as null texts, are never found."""
    ids, texts, held = [], [], 0
    for row in benchmark.select(F.col(key).cast("long"), F.col(text)).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        held += len((row[1] or "").split())
        if held >= limit:
            yield Items.of(ids, texts, size)
            ids, texts, held = [], [], 0
    if ids:
        yield Items.of(ids, texts, size)


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, size: int = MIN_MATCH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every pair of a document and an item it holds.

    ``doc_id, item_id, item_tokens, covered, coverage, n_tiles, longest``.  Each row of ``docs``
    is judged on its own: repeated rows give repeated pairs, null texts give none, a null id stays null.
    """
    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id bigint, item_id bigint, item_tokens bigint, covered bigint, coverage double, n_tiles bigint, longest bigint"
    result = None
    for items in benchmark_blocks(benchmark, size):
        block = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            known = block.value
            for part in slices(batches):
                ids, found = part.column("doc_id"), known.found_in(part.column("text"), coverage)
                rows = [(ids[r].as_py(), known.ids[i], len(known.tokens[i]), c, c / len(known.tokens[i]), n, top) for r, i, c, n, top in found]
                cols = list(zip(*rows, strict=True)) if rows else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.float64() if k == 4 else pa.int64()) for k, c in enumerate(cols)],
                    names=["doc_id", "item_id", "item_tokens", "covered", "coverage", "n_tiles", "longest"])

        pairs = picked.mapInArrow(run, schema)
        result = pairs if result is None else result.unionByName(pairs)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, size: int = MIN_MATCH, text: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that hold an item."""
    at = docs.columns.index(text)
    for items in benchmark_blocks(benchmark, size):
        block = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, at):
                keep = np.ones(part.num_rows, bool)
                keep[[f[0] for f in block.value.found_in(part.column(at), coverage)]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
