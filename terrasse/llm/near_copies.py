"""Near copies for the pipeline: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash finds candidates, the shingle sets decide.  A fingerprint has 256 bits over the distinct
shingles: at similarity 0.8 two of them differ in about 39 bits, unrelated ones in about 128, so
`RADIUS` loses next to nothing and lets next to nothing else through.  The first 64 bits are compared
in tiles of documents whose set sizes allow the similarity; only pairs within `FIRST` look at the rest.

Candidate links, thinned to spanning forests, give candidate components.  Within each, all pairs of
shingle sets are compared exactly, in pairs of chunks, so that a large component is many tasks.
A document stays unless a chain of similar pairs leads to a smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasse.llm.components import connected
from terrasse.llm.simhash import forest, shingle_hashes
from terrasse.llm.words import mix, runs_of, slices
from terrasse.settings import BROADCAST_ROWS, durable, durable_counted, limit_of

SHINGLE, NUM, DEN = 5, 4, 5  # similarity NUM / DEN
WORDS, FIRST, RADIUS = 4, 22, 64  # 64-bit words of a fingerprint; bits that may differ in the first, in all
TILE, MOST_TILE, BLOCK = 4096, 65_536, 64
CHUNK_ROWS, CHUNK_SHINGLES, CHUNKS, MOST_SHINGLES = 128, 1 << 17, 64, 1 << 21
SALT = [np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64)) for k in range(WORDS + 2)]
FPS = [f"f{k}" for k in range(WORDS)]


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within a row, and where each row starts and the last one ends."""
    hashes, row = shingle_hashes(texts, SHINGLE)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    if len(hashes):
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])))
        hashes, row = hashes[new], row[new]
    return hashes, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(texts)))))


def _sums(hashes: np.ndarray, ends: np.ndarray, salt: np.uint64) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + salt), dtype=np.uint64)))
    return total[ends[1:]] - total[ends[:-1]]


def prints_of(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``WORDS`` words per set; a bit is 1 if it is 1 for over half the shingles."""
    n = np.diff(ends)
    row = np.repeat(np.arange(len(n)), n)
    ones = np.zeros((len(n), 64 * WORDS), np.int64)
    for a in range(0, len(hashes), 1 << 15):
        h, r = hashes[a : a + (1 << 15)], row[a : a + (1 << 15)]
        cuts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        all_words = np.stack([h if k == 0 else mix(h + SALT[k]) for k in range(WORDS)], axis=1).astype("<u8")
        bits = np.unpackbits(all_words.view(np.uint8).reshape(-1, 8 * WORDS), axis=1, bitorder="little")
        ones[r[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8")


def _described(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, the digest of its set (``d0, d1, n``) and its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, ends = shingle_sets(part.column("text"))
            prints = prints_of(hashes, ends)
            made = [_sums(hashes, ends, s).view(np.int64) for s in SALT[-2:]] + [np.diff(ends)] + [np.ascontiguousarray(prints[:, k]).view(np.int64) for k in range(WORDS)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, made)], names=["doc_id", "d0", "d1", "n", *FPS])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return picked.mapInArrow(run, ", ".join(f"{c} bigint" for c in ["doc_id", "d0", "d1", "n", *FPS]))


def tile_links(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of two tiles (words x documents), numbered in a row, each with a link to the smallest it reaches."""
    n = len(na) + len(nb)
    u, v, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for i in range(0, len(na), BLOCK):
        x, y = np.nonzero(np.bitwise_count(a[0, i : i + BLOCK, None] ^ b[0][None]) <= FIRST)
        x += i
        near = np.bitwise_count(a[:, x] ^ b[:, y]).sum(axis=0, dtype=np.int64) <= RADIUS
        near &= (DEN * na[x] >= NUM * nb[y]) & (DEN * nb[y] >= NUM * na[x])
        u.append(x[near])
        v.append(y[near] + len(na))
        held += len(u[-1])
        if held > 1 << 20:  # keep the tree, drop the rest
            u, v, held = [np.arange(n)], [forest(np.concatenate(u), np.concatenate(v), n)], n
    if not held:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    label = forest(np.concatenate(u), np.concatenate(v), n)
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def candidate_links(nodes: DataFrame, total: int) -> DataFrame:
    """Links ``(u, v)`` between ids of ``nodes (id, n, f0 …)``, enough to connect all candidates.

    Cells hold sets of a size within a factor DEN / NUM, so only the same and the next cell can be similar.
    Tiles grow with the number of nodes: each goes to as many others as there are in its two cells.
    """
    tile = min(MOST_TILE, max(TILE, total // 256))
    cell = F.when(F.col("n") > 0, F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM)))).otherwise(-9).cast("int")
    placed = nodes.withColumn("cell", cell)
    small = F.broadcast(durable(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")), "near-cells"))  # one row per factor of size
    packed = ["id", "n", *FPS]
    tiles = durable(
        placed.join(small, "cell").groupBy("cell", F.expr("cast(pmod(xxhash64(id, f0), tiles) as int)").alias("tile")).agg(F.collect_list(F.struct(*packed)).alias("rows")), "near-tiles")
    tiles = tiles.select("cell", "tile", *(F.col(f"rows.{c}").alias(c) for c in packed))
    left = tiles.withColumnsRenamed({"cell": "own", "tile": "own_tile"}).withColumn("cell", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    left = left.join(small, "cell").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    left = left.where((F.col("own") != F.col("cell")) | (F.col("tile") >= F.col("own_tile"))).drop("tiles", "own", "own_tile")
    pairs = left.join(tiles.withColumnsRenamed({c: f"{c}_2" for c in packed}), ["cell", "tile"]).select(*packed, *(f"{c}_2" for c in packed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in batch.columns]
            for i in range(batch.num_rows):
                ia, na, *a, ib, nb = (found := [values[o[i] : o[i + 1]] for o, values in columns])[: len(packed) + 2]
                b = found[len(packed) + 2 :]
                node, label = tile_links(np.stack(a).view(np.uint64), np.stack(b).view(np.uint64), na, nb)
                ids = np.concatenate((ia, ib))
                u, v = ids[node], ids[label]
                yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])

    return pairs.mapInArrow(run, "u bigint, v bigint")


def similar_sets(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each set the smallest one that a chain of similar pairs leads to; every pair of sets is decided exactly."""
    n = np.diff(ends)
    _, value = np.unique(hashes, return_inverse=True)
    owner = np.repeat(np.arange(len(n)), n)
    wide = int(value.max(initial=-1)) + 1

    def like(i: int) -> np.ndarray:
        mine = np.zeros(wide, bool)
        mine[value[ends[i] : ends[i + 1]]] = True
        shared = np.bincount(owner, mine[value], minlength=len(n)).astype(np.int64)
        return (NUM + DEN) * shared >= NUM * (n + n[i])

    # One set joins all that resemble it; pairs among those need no look, all others meet below.
    star = max((like(i) for i in sorted({0, len(n) // 2, len(n) - 1})), key=np.count_nonzero)
    hub = np.flatnonzero(star)
    u, v = [hub], [np.full(len(hub), hub[0] if len(hub) else 0)]
    rest = ~star[owner]
    order = np.argsort(value[rest], kind="stable")
    holders = owner[rest][order]  # sets outside the star, by shingle
    count = np.bincount(value[rest], minlength=wide)
    first = np.cumsum(count) - count
    for i in range(len(n)):
        mine = value[ends[i] : ends[i + 1]]
        many = count[mine]
        if not many.any():
            continue
        other, shared = np.unique(holders[np.repeat(first[mine], many) + runs_of(many)], return_counts=True)
        other = other[(NUM + DEN) * shared >= NUM * (n[other] + n[i])]
        u.append(other)
        v.append(np.full(len(other), i))
    return forest(np.concatenate(u), np.concatenate(v), len(n))


def verified_links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Links ``(u, v)`` between ids of one component ``found (node, root)``, enough to connect all similar documents."""
    picked = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(found, F.col("id") == F.col("node")).select("id", "root", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, ends = shingle_sets(part.column("text"))
            digest = [pa.array(_sums(hashes, ends, s).view(np.int64)) for s in SALT[-2:]]
            data = pa.array([hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("root"), *digest, data], names=["id", "root", "d0", "d1", "shingles"])

    members = picked.mapInArrow(sets, "id bigint, root bigint, d0 bigint, d1 bigint, shingles binary")
    members = durable(members.groupBy("id", "root", "d0", "d1").agg(F.min("shingles").alias("shingles")), "near-sets")
    held = F.sum(F.length("shingles")) / 8
    wanted = F.least(F.lit(CHUNKS), F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK_ROWS, held / CHUNK_SHINGLES)))
    sizes = members.groupBy("root").agg(F.greatest(F.lit(1), wanted, F.ceil(held / MOST_SHINGLES)).cast("int").alias("chunks"))
    # Only components of several chunks are looked up, and not by a shuffle that would deal a whole one to one task.
    large, n_large = durable_counted(sizes.where("chunks > 1"), "near-sizes")
    if n_large <= limit_of(docs.sparkSession, BROADCAST_ROWS):
        large = F.broadcast(large)
    members = members.join(large, "root", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    place = F.expr("cast(pmod(xxhash64(id, d0, d1), chunks) as int)")
    chunks = durable(
        members.groupBy("root", "chunks", place.alias("chunk")).agg(F.collect_list(F.struct("id", "shingles")).alias("rows"))
        .select("root", "chunks", "chunk", F.col("rows.id").alias("ids"), F.col("rows.shingles").alias("shingles")), "near-chunks")
    lone = chunks.where("chunks = 1").select("ids", "shingles", F.lit(None).cast("array<bigint>").alias("ids2"), F.lit(None).cast("array<binary>").alias("shingles2"))
    left = chunks.where("chunks > 1").select("root", F.col("ids").alias("ids"), F.col("shingles"), F.col("chunk").alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    # A pair of chunks looks at both chunks whole, so a chunk meets itself wherever it meets another.
    left = left.where("own < chunk")
    right = chunks.where("chunks > 1").select("root", "chunk", F.col("ids").alias("ids2"), F.col("shingles").alias("shingles2"))
    pairs = lone.unionByName(left.join(right, ["root", "chunk"]).select("ids", "shingles", "ids2", "shingles2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for i in range(batch.num_rows):
                ids, held = [], []
                for k in (0, 2):
                    if batch.column(k)[i].is_valid:
                        ids += batch.column(k)[i].as_py()
                        held += batch.column(k + 1)[i].as_py()
                label = similar_sets(np.frombuffer(b"".join(held), np.uint64), np.concatenate(([0], np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) // 8))))
                ids = np.array(ids, np.int64)
                us.append(ids)
                vs.append(ids[label])
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])

    return pairs.mapInArrow(run, "u bigint, v bigint")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, its smallest id; rows of one id stay or go together, rows without id stay.

    Documents of equal sets meet first (map-side combined minimum), so exact copies, however many, are
    one node.  Documents without words are copies of each other.
    """
    seen = durable(_described(docs), "near-prints")
    digest = ["d0", "d1", "n"]
    nodes, total = durable_counted(seen.where("doc_id is not null").groupBy(*digest, *FPS).agg(F.min("doc_id").alias("id")), "near-nodes")
    found = connected(candidate_links(nodes, total))
    roots = durable(connected(verified_links(docs, found)), "near-roots")
    low = nodes.join(roots, nodes["id"] == roots["node"], "left").select(*digest, F.coalesce("root", "id").alias("kept"))
    gone = seen.join(low, digest).where("kept <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
