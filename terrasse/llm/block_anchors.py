"""Exact substring deduplication by fixed-block anchors.

Non-overlapping blocks of ``BLOCK`` words of every document are the index; every rolling window
of ``BLOCK`` words of every document probes it.  A repeat of ``LENGTH >= 2 * BLOCK - 1`` words
always holds a whole block of the document it repeats, so no repeat is missed.  Anchors that two
documents share are extended to both sides: the windows of ``LENGTH`` words around an anchor are
matched exactly (two independent 64-bit hashes), and the union of the matched windows is the
maximal repeat.  Only the smallest document of each window is kept, by map-side combined minima
and a join that skew handling may split, so a passage in very many documents never gives pairs.

The index travels as a Bloom filter of at most 32 MB.  On a corpus too large for it, more
windows pass and meet the exact aggregation; results are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasse.llm import bloom
from terrasse.llm.words import BASES, Words, rolling, slices, split_words, windows
from terrasse.settings import durable

LENGTH, BLOCK = 50, 25
COPY_GROUPS = 1 << 18  # most frequent groups of whole copies set aside early; the others go the ordinary way


def _joined(words: Words) -> list[bytes]:
    """Each row's words joined by one space."""
    flat = [words.vocab[i] for i in words.ids.tolist()]
    return [b" ".join(flat[a:b]) for a, b in zip(words.starts[:-1].tolist(), words.starts[1:].tolist(), strict=True)]


def _longs(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _copies(picked: DataFrame, length: int) -> tuple[dict[bytes, int], int]:
    """First document of frequent groups of equal word sequences, and the number of words of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"))
            digests = [xxhash.xxh3_128_digest(j) for j in _joined(words)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.counts), pa.array(digests, pa.binary())], names=["doc_id", "n", "digest"])

    rows = durable(picked.mapInArrow(run, "doc_id bigint, n bigint, digest binary"), "sequences")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = rows.where(F.col("n") >= length).groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    top = groups.orderBy(F.desc("c"), "digest").limit(COPY_GROUPS).select("digest", "first")
    return {bytes(r["digest"]): r["first"] for r in top.toLocalIterator()}, total


def remove_repeats(docs: DataFrame, length: int = LENGTH, block: int = BLOCK, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Takes out each word covered by a window of ``length`` words that also starts in a document with a smaller id.

    One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of the kept
    words joined by one space, and ``kept_text``, those words, where something was removed (null:
    nothing was).  Null and empty texts have no words.  Rows of one id are repeats of one row
    and treated alike; rows without id keep all words and serve nobody as a reference.
    """
    if length < 2 * block - 1:
        raise ValueError("a window must be able to hold a whole block")
    spark = docs.sparkSession
    every = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    picked = every.where("doc_id is not null")
    copies, total = _copies(picked, length)
    copies = spark.sparkContext.broadcast(copies)

    def copied(ids: list, joined: list[bytes]) -> np.ndarray:
        """Rows that repeat the whole of a smaller document."""
        known = copies.value
        if not known:
            return np.zeros(len(ids), bool)
        first = [known.get(xxhash.xxh3_128_digest(j)) for j in joined]
        return np.array([f is not None and i is not None and i > f for i, f in zip(ids, first, strict=True)], bool)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"))
            at = windows(words.starts, block)
            at = at[(at - words.starts[words.row[at]]) % block == 0]
            yield pa.RecordBatch.from_arrays([_longs(np.unique(rolling(words.hashes(), at, block)))], names=["h"])

    index = bloom.build(picked.mapInArrow(blocks, "h bigint"), total // block)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"))
            ids = part.column("doc_id")
            skip = copied(ids.to_pylist(), _joined(words))
            at = windows(words.starts, block)
            h = rolling(words.hashes(), at, block)
            row = words.row[at]
            hit = index.value.contains(h) & ~skip[row]
            h, doc = h[hit], ids.to_numpy()[row[hit]]
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            if len(h):
                first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                last = np.append(first[1:], len(h)) - 1
                yield pa.RecordBatch.from_arrays([_longs(h[first]), pa.array(doc[first]), pa.array(doc[last])], names=["h", "lo", "hi"])

    hits = picked.mapInArrow(probe, "h bigint, lo bigint, hi bigint")
    shared = durable(hits.groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("h"), "anchors")
    anchors = bloom.build(shared, shared.count())

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows around anchors; only rows that have some carry their words on."""
        empty = hashlib.sha256(b"").hexdigest()
        for part in slices(batches):
            words = split_words(part.column("text"))
            joined, ids = _joined(words), part.column("doc_id")
            gone = copied(ids.to_pylist(), joined)
            out = gone | ids.is_null().to_numpy(zero_copy_only=False)
            one = words.hashes()
            start = windows(words.starts, block)
            mark = np.zeros(len(one) + 1, np.int64)
            mark[start[anchors.value.contains(rolling(one, start, block))] + 1] = 1
            mark = np.cumsum(mark)
            at = windows(words.starts, length)
            at = at[(mark[at + length - block + 1] > mark[at]) & ~out[words.row[at]]]
            row = words.row[at]
            offsets = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
            some = np.bincount(row, minlength=part.num_rows) > 0
            lists = [pa.ListArray.from_arrays(offsets, v) for v in (
                _longs(rolling(one, at, length)), _longs(rolling(words.hashes(1), at, length, BASES[1])), pa.array((at - words.starts[row]).astype(np.int32)))]
            body = [j if s else None for j, s in zip(joined, some, strict=True)]
            sha = [empty if g else None if s else hashlib.sha256(j).hexdigest() for j, s, g in zip(joined, some, gone, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(words.counts), pa.array(np.where(gone, words.counts, 0)), pa.array(body, pa.binary()).cast(pa.string()), pa.array(sha, pa.string()), *lists],
                names=["doc_id", "n_words", "n_removed", "body", "sha", "one", "two", "at"])

    # Texts are most of what this stage holds, and take a third less than with the usual codec.
    state = durable(every.mapInArrow(extend, "doc_id bigint, n_words bigint, n_removed bigint, body string, sha string, one array<bigint>, two array<bigint>, at array<int>"), "extended", "zstd")
    found = state.where("size(at) > 0").select("doc_id", F.explode(F.arrays_zip("one", "two", "at")).alias("w")).select("doc_id", "w.*")
    first = found.groupBy("one", "two").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("one", "two", "lo")
    first = durable(first, "first-windows")
    covered = found.join(first, ["one", "two"]).where("doc_id > lo").groupBy("doc_id").agg(F.collect_set("at").alias("at"))
    joined = state.drop("one", "two", "at").join(covered, "doc_id", "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body"):
            cols = part.to_pydict()
            for i, (body, at) in enumerate(zip(cols["body"], cols["at"], strict=True)):
                if body is None:
                    cols["body"][i] = "" if cols["n_removed"][i] else None
                    continue
                words = body.split(" ")
                if at:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, np.array(at), 1)
                    np.add.at(edge, np.array(at) + length, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                    cols["n_removed"][i] = int(len(keep) - keep.sum())
                kept = " ".join(words)
                cols["sha"][i] = hashlib.sha256(kept.encode()).hexdigest()
                cols["body"][i] = kept if at else None
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_words"), pa.array(cols["n_removed"], pa.int64()), pa.array(cols["sha"], pa.string()), pa.array(cols["body"], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return joined.mapInArrow(remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
