"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are laid out in tiles that share the population counts of their ``SEGMENTS``
16-bit segments.  The counts of two fingerprints at distance d differ by at most d in sum, so
only tile pairs whose counts differ by at most the radius are compared, each as one exclusive-or
and bit count over two numpy arrays.  No other pair can link, so no link is lost.  A cell of counts
with many fingerprints is cut into tiles of about ``TILE`` rows, which bounds every task.

A tile pair hands on a spanning forest of its links, never all of them, so a large group of near
copies gives rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.llm.components import connected
from terrasse.llm.words import plain, slices, split_words, windows
from terrasse.settings import durable

SHINGLE, SEED, RADIUS = 3, 42, 2
SEGMENTS, TILE, BLOCK = 4, 4096, 256
WIDTH = 64 // SEGMENTS


def shingle_hashes(texts: pa.Array, size: int = SHINGLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, repeats included, and the row of each; short texts are one shingle."""
    words = split_words(pc.ascii_lower(plain(texts)))
    joined = b" ".join([words.vocab[i] for i in words.ids])
    length = np.fromiter(map(len, words.vocab), np.int64, len(words.vocab))[words.ids]
    end = np.cumsum(length + 1) - 1
    first = windows(words.starts, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    a = np.concatenate((first, words.starts[short]))
    b = np.concatenate((first + size - 1, words.starts[short + 1] - 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[x:y], seed) for x, y in zip((end[a] - length[a]).tolist(), end[b].tolist(), strict=True)), np.uint64, len(a))
    row, order = words.row[a], slice(None)
    if len(short):
        order = np.argsort(row, kind="stable")
    return hashes[order], row[order]


def fingerprints(texts: pa.Array, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """A bit is 1 if it is 1 in over half the shingle hashes; 0 for a text without words."""
    hashes, row = shingle_hashes(texts, size, seed)
    ones = np.zeros((len(texts), 64), np.int64)
    for a in range(0, len(hashes), 1 << 17):
        h, r = hashes[a : a + (1 << 17)], row[a : a + (1 << 17)]
        cuts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[r[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    n = np.bincount(row, minlength=len(texts))
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``fp``, the fingerprint as a signed long.  Null text: 0."""
    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(fingerprints(part.column("text")).view(np.int64))], names=["doc_id", "fp"])

    return picked.mapInArrow(run, "doc_id bigint, fp bigint")


def _cell(fp: Column) -> Column:
    """Population counts of all segments, packed into one number."""
    counts = [F.bit_count(F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))) for i in range(SEGMENTS)]
    return sum((c * (WIDTH + 1) ** i for i, c in enumerate(counts[1:], 1)), counts[0]).cast("int")


def _near_cells(cell: Column, radius: int) -> Column:
    """The cell itself and every later cell whose counts differ by at most ``radius`` in sum."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=SEGMENTS) if sum(map(abs, s)) <= radius]
    later = [s for s in steps if s[::-1] >= (0,) * SEGMENTS]
    made = []
    for s in later:
        inside = F.lit(True)
        for i, d in enumerate(s):
            if d:
                count = (cell / (WIDTH + 1) ** i).cast("int") % (WIDTH + 1) + d
                inside = inside & count.between(0, WIDTH)
        made.append(F.when(inside, cell + sum(d * (WIDTH + 1) ** i for i, d in enumerate(s))))
    return F.array_compact(F.array(*made))


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 … n-1 the smallest node each reaches over the given links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the two tiles, numbered in a row, and one link from each to the smallest it reaches."""
    held_u, held_v, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    n = len(a) + len(b)

    def settle() -> np.ndarray:
        return forest(np.concatenate(held_u), np.concatenate(held_v), n)

    for i in range(0, len(a), BLOCK):
        x, y = np.nonzero(np.bitwise_count(a[i : i + BLOCK, None] ^ b[None]) <= radius)
        held_u.append(x + i)
        held_v.append(y + len(a))
        held += len(x)
        if held > 1 << 20:  # keep the tree, drop the rest
            label = settle()
            held_u, held_v, held = [np.arange(n)], [label], n
    if not held:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    label = settle()
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(u, v)`` between the ids of ``prints (fp, id)``, one row per fingerprint, enough to connect all that link.

    Within a tile the same-fingerprint node appears on both sides; both numbers stand for one id.
    """
    cells = durable(prints.groupBy(_cell(F.col("fp")).alias("cell")).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles")), "cells")
    small = F.broadcast(cells)  # at most (WIDTH + 1)^SEGMENTS rows, 83,521 as set
    placed = prints.withColumn("cell", _cell(F.col("fp"))).join(small, "cell")
    tiles = durable(
        placed.groupBy("cell", F.expr("cast(pmod(xxhash64(fp), tiles) as int)").alias("tile"))
        .agg(F.collect_list("fp").alias("fps"), F.collect_list("id").alias("ids")), "tiles")
    left = tiles.select("fps", "ids", F.col("cell").alias("own"), F.col("tile").alias("own_tile"), F.explode(_near_cells(F.col("cell"), radius)).alias("cell"))
    left = left.join(small, "cell").select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    left = left.where((F.col("own") != F.col("cell")) | (F.col("tile") >= F.col("own_tile"))).drop("tiles", "own", "own_tile")
    pairs = left.join(tiles.withColumnsRenamed({"fps": "fps2", "ids": "ids2"}), ["cell", "tile"]).select("fps", "ids", "fps2", "ids2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns]
            us, vs = [], []
            for i in range(batch.num_rows):
                a, ia, b, ib = (values[o[i] : o[i + 1]] for o, values in cols)
                node, label = tile_links(a.view(np.uint64), b.view(np.uint64), radius)
                ids = np.concatenate((ia, ib))
                us.append(ids[node])
                vs.append(ids[label])
            u, v = np.concatenate(us), np.concatenate(vs)
            real = u != v
            yield pa.RecordBatch.from_arrays([pa.array(u[real]), pa.array(v[real])], names=["u", "v"])

    return pairs.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Equal fingerprints meet first (map-side combined minimum), so exact copies, however many,
    are one node.  Documents without words have fingerprint zero and link like any other; null
    texts count as empty.  Rows with a null id get a fingerprint and a null component; repeated
    rows get the same answer each; other columns are not looked at.
    """
    prints = durable(fingerprint_documents(docs, key, text), "fingerprints")
    nodes = durable(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    found = connected(links(nodes, radius))
    roots = nodes.join(found, nodes["id"] == found["node"], "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return prints.join(roots, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each group, its smallest id; rows of one id stay or go together, rows without id stay."""
    gone = near_duplicates(docs, radius).where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
