"""Reversible line deduplication: sharded cuckoo filters backed by exact reference counts.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case.
A ledger is a folder of numbered batches.  A batch holds

* ``docs``: the keys (128-bit digests) of each document inserted, or the ids deleted,
* ``counts``: signed changes of the number of documents that hold a key (their sum is the exact
  reference count),
* ``filters``: one cuckoo filter per shard with the keys that at least ``min_docs`` documents
  hold now.  A batch puts keys in and takes keys out as counts cross the threshold.

``filters`` is written last; a batch without it never took place and is overwritten.  Dropping
lines probes the filters first, so only lines that are probably repeated meet the exact counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from terrasse.llm.words import mix, slices
from terrasse.settings import durable, path_exists

MIN_CHARS, MIN_DOCS, SHARDS = 40, 5, 64
SHARD_KEYS = 500_000  # repeated keys of the first batch that a shard is made for, from ``SHARDS`` shards on
FILTER_BYTES = 64 << 20  # larger filters are not sent to every task; all long lines then meet the exact counts
SLOTS, KICKS = 4, 500


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def digest(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit digest of a line's key, None if the key is too short."""
    key = line_key(line)
    if len(key) < min_chars or not (key.isascii() or len(key.decode()) >= min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers for each 16-byte key (an array of dtype S16 or V16 seen as bytes)."""
    both = keys.view("<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (_halves(keys)[0] % np.uint64(shards)).astype(np.int64)


class CuckooFilter:
    """Buckets of four 16-bit marks; a key's mark lies in one of two buckets.

    Deleting is exact for keys that were inserted.  An insertion that finds no room returns
    False and the caller rebuilds at double size from the exact counts.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets  # a power of two
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.85)))))

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        table = np.frombuffer(blob, "<u2").reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return places(keys, np.uint64(self.buckets - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(keys)
        return ((self.table[one] == mark[:, None]) | (self.table[two] == mark[:, None])).any(axis=1)

    def insert(self, key: np.ndarray) -> bool:
        (mark,), (one,), (two,) = self.places(key)
        for at in (one, two):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = mark
                return True
        for kick in range(KICKS):
            at = two
            mark, self.table[at, kick % SLOTS] = self.table[at, kick % SLOTS], mark
            two = at ^ (mix(np.array([mark], np.uint64))[0] & np.uint64(self.buckets - 1))
            free = np.flatnonzero(self.table[two] == 0)
            if len(free):
                self.table[two, free[0]] = mark
                return True
        return False

    def delete(self, key: np.ndarray) -> bool:
        (mark,), (one,), (two,) = self.places(key)
        for at in (one, two):
            held = np.flatnonzero(self.table[at] == mark)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False


def places(keys: np.ndarray, mask: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mark and the two buckets of each key."""
    low, high = _halves(keys)
    mark = (high >> np.uint64(48)).astype(np.uint16)
    mark[mark == 0] = 1
    one = mix(low) & mask
    return mark, one, one ^ (mix(mark.astype(np.uint64)) & mask)


class Filters:
    """All shards' filters as one flat table, probed for many keys at once."""

    def __init__(self, blobs: dict[int, bytes], shards: int):
        tables = [np.frombuffer(blobs[s], "<u2").reshape(-1, SLOTS) if s in blobs else np.zeros((1, SLOTS), np.uint16) for s in range(shards)]
        size = np.array([len(t) for t in tables], np.uint64)
        self.shards, self.mask, self.start, self.table = shards, size - np.uint64(1), np.cumsum(size) - size, np.concatenate(tables)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        shard = shard_of(keys, self.shards)
        mark, one, two = places(keys, self.mask[shard])
        first = self.start[shard]
        return ((self.table[one + first] == mark[:, None]) | (self.table[two + first] == mark[:, None])).any(axis=1)


def document_keys(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id`` and the distinct digests of its long lines; documents without id or long lines give no row."""
    picked = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            found = [list(dict.fromkeys(d for line in (t or b"").split(b"\n") if (d := digest(line, min_chars)))) for t in texts]
            some = np.array([bool(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").filter(pa.array(some)), pa.array([x for x in found if x], pa.list_(pa.binary()))], names=["doc_id", "keys"])

    return picked.mapInArrow(run, "doc_id bigint, keys array<binary>")


class LineLedger:
    """Insert documents, delete documents, drop repeated lines; state lives in ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS):
        self.spark, self.path = spark, path.rstrip("/")
        self._wanted, self.min_docs, self.min_chars = shards, min_docs, min_chars

    def _at(self, batch: int, part: str) -> str:
        return f"{self.path}/batch-{batch:06d}/{part}"

    @property
    def batches(self) -> int:
        n = 0
        while path_exists(self.spark, self._at(n, "filters/_SUCCESS")):
            n += 1
        return n

    def _read(self, part: str, schema: str, batches: int) -> DataFrame:
        paths = [self._at(i, part) for i in range(batches)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def documents(self) -> DataFrame:
        """Keys of the documents that are in now: the last change of an id counts."""
        n = self.batches
        logs = [self._read_one(i) for i in range(n)]
        if not logs:
            return self.spark.createDataFrame([], "doc_id bigint, keys array<binary>")
        if n == 1:
            return logs[0].where("keys is not null").select("doc_id", "keys")
        every = reduce(DataFrame.unionByName, logs)
        last = every.groupBy("doc_id").agg(F.max("batch").alias("batch"))
        return every.join(last, ["doc_id", "batch"]).where("keys is not null").select("doc_id", "keys")

    def _read_one(self, batch: int) -> DataFrame:
        return self.spark.read.schema("doc_id bigint, keys array<binary>").parquet(self._at(batch, "docs")).withColumn("batch", F.lit(batch))

    def counts(self) -> DataFrame:
        """Exact ``(key, n_docs)``, zeros left out."""
        n = self.batches
        rows = self._read("counts", "key binary, n_docs bigint", n)
        return rows if n == 1 else rows.groupBy("key").agg(F.sum("n_docs").alias("n_docs")).where("n_docs > 0")

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> None:
        """Rows of one id are one document.  Ids that are in already are refused."""
        n, found = self.batches, document_keys(docs, key, text, self.min_chars)
        if n and self.documents().join(found, "doc_id", "left_semi").limit(1).count():
            raise ValueError("some ids are in the ledger; delete them first")
        self._write(n, found, 1)

    def delete(self, ids: DataFrame, key: str = "doc_id") -> None:
        """Take documents out by id; ids that are not in are ignored."""
        ids = ids.select(F.col(key).cast("long").alias("doc_id")).distinct()
        self._write(self.batches, self.documents().join(ids, "doc_id", "left_semi"), -1)

    def _write(self, n: int, found: DataFrame, sign: int) -> None:
        kept = found if sign > 0 else durable(found, "deleted")
        log = kept if sign > 0 else kept.select("doc_id", F.lit(None).cast("array<binary>").alias("keys")).distinct()
        log.write.mode("overwrite").parquet(self._at(n, "docs"))
        source = self._read_one(n) if sign > 0 else kept
        pairs = source.select("doc_id", F.explode("keys").alias("key"))
        change = pairs.groupBy("key").agg((F.lit(sign) * F.count_distinct("doc_id")).cast("long").alias("n_docs"))
        change.write.mode("overwrite").parquet(self._at(n, "counts"))
        change = self.spark.read.schema("key binary, n_docs bigint").parquet(self._at(n, "counts"))
        if n:
            before = self._read("counts", "key binary, n_docs bigint", n).join(change.select("key"), "key", "left_semi")
            before = before.groupBy("key").agg(F.sum("n_docs").alias("was"))
            moved = change.join(before, "key", "left").select("key", F.coalesce("was", F.lit(0)).alias("was"), (F.coalesce("was", F.lit(0)) + F.col("n_docs")).alias("now"))
        else:
            moved = change.select("key", F.lit(0).alias("was"), F.col("n_docs").alias("now"))
        self._write_filters(n, moved.where((F.col("was") >= self.min_docs) != (F.col("now") >= self.min_docs)))

    @property
    def shards(self) -> int:
        """Stored with the ledger, so that every batch and reader deals keys alike."""
        return self.spark.read.schema("shards int").parquet(f"{self.path}/shards").first()[0]

    def _fix_shards(self, moved: DataFrame) -> None:
        """As many shards as the first batch's repeated keys call for, unless a number was given."""
        found = moved.where(F.col("now") >= self.min_docs).select(F.greatest(F.lit(SHARDS), F.ceil(F.count(F.lit(1)) / SHARD_KEYS)).cast("int").alias("shards"))
        if self._wanted:
            found = self.spark.range(1).select(F.lit(self._wanted).alias("shards"))
        found.write.mode("overwrite").parquet(f"{self.path}/shards")

    def _write_filters(self, n: int, moved: DataFrame) -> None:
        """A new filter per shard: the last one with the keys of the batch put in or taken out.

        A shard's keys are one group of ``SHARD_KEYS`` on average in the first batch; give a number of shards to
        a ledger whose first batch is a small part.  Full filters are rebuilt at double size from all keys.
        """
        if not n:
            self._fix_shards(moved)
        shards, limit, old = self.shards, self.min_docs, self._read("filters", "shard int, blob binary, n bigint", n) if n else None

        def shard(keys: pd.Series) -> pd.Series:
            flat = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
            return pd.Series(shard_of(flat, shards).astype(np.int32))

        place = F.pandas_udf(shard, "int")
        rows = moved.select(place("key").alias("shard"), "key", (F.col("now") >= limit).alias("put"), F.lit(None).cast("binary").alias("blob"))
        if old is not None:
            last = self.spark.read.schema("shard int, blob binary, n bigint").parquet(self._at(n - 1, "filters"))
            rows = rows.unionByName(last.select("shard", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("boolean").alias("put"), "blob"))

        def update(group: pd.DataFrame) -> pd.DataFrame:
            keys = group[group["key"].notna()]
            held = [b for b in group["blob"] if b is not None]
            put = [np.frombuffer(k, np.uint8) for k in keys.loc[keys["put"].astype(bool), "key"]]
            out = [np.frombuffer(k, np.uint8) for k in keys.loc[~keys["put"].astype(bool), "key"]]
            made = CuckooFilter.load(held[0]) if held else CuckooFilter.sized(len(put))
            full = not (all(made.delete(k) for k in out) and all(made.insert(k) for k in put))
            return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "blob": [b"" if full else made.dump()], "n": [len(put) - len(out)]})

        target = self._at(n, "filters")
        fresh = durable(rows.groupBy("shard").applyInPandas(update, "shard int, blob binary, n bigint"), "filters")
        full = fresh.where(F.length("blob") == 0).select("shard")
        if full.count():
            every = self._read("counts", "key binary, n_docs bigint", n + 1).groupBy("key").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= limit)
            again = every.select(place("key").alias("shard"), "key").join(F.broadcast(full), "shard")

            def rebuild(group: pd.DataFrame) -> pd.DataFrame:
                put, size = [np.frombuffer(k, np.uint8) for k in group["key"]], 2 * len(group)
                while True:
                    made = CuckooFilter.sized(size)
                    if all(made.insert(k) for k in put):
                        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "blob": [made.dump()], "n": [len(put)]})
                    size *= 2

            fresh = fresh.where(F.length("blob") > 0).unionByName(again.groupBy("shard").applyInPandas(rebuild, fresh.schema))
        fresh.write.mode("overwrite").parquet(target)

    def filters(self) -> Broadcast | None:
        """The filters of the last batch for every task, or None if they are larger than ``FILTER_BYTES``."""
        n = self.batches
        rows = self.spark.read.schema("shard int, blob binary, n bigint").parquet(self._at(n - 1, "filters"))
        size = rows.agg(F.coalesce(F.sum(F.length("blob")), F.lit(0))).first()[0]
        if size > FILTER_BYTES:
            return None
        return self.spark.sparkContext.broadcast(Filters({r["shard"]: r["blob"] for r in rows.collect()}, self.shards))

    def dropped(self) -> DataFrame:
        """``(doc_id, drop)``: per document the digests of the lines it loses.

        A key that at least ``min_docs`` documents hold stays in the one with the largest id.
        """
        filters = self.filters()
        held = self.documents()
        if filters is not None:

            def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    keys = batch.column("keys")
                    flat = keys.flatten()
                    hit = filters.value.contains(np.frombuffer(b"".join(flat.to_pylist()), np.uint8).reshape(-1, 16)) if len(flat) else np.zeros(0, bool)
                    ids = np.repeat(batch.column("doc_id").to_numpy(), np.diff(keys.offsets.to_numpy()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), flat.filter(pa.array(hit))], names=["doc_id", "key"])

            pairs = held.mapInArrow(probe, "doc_id bigint, key binary")
        else:
            pairs = held.select("doc_id", F.explode("keys").alias("key"))
        pairs = durable(pairs, "repeated-lines")
        often = self.counts().where(F.col("n_docs") >= self.min_docs).select("key")
        holders = pairs.groupBy("key").agg(F.max("doc_id").alias("last"))  # combined on the map side, a line in very many documents too
        last = durable(holders.join(often, "key"), "last-holders")
        return pairs.join(last, "key").where("doc_id <> last").groupBy("doc_id").agg(F.collect_set("key").alias("drop"))

    def clean(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` with its own columns, repeated lines taken out of ``text``, then ``__n_lines`` and ``__n_dropped``.

        Null text is one empty line and comes out as empty text; rows without id or unknown to the ledger keep all lines.
        """
        drops = self.dropped().select(F.col("doc_id").alias("__id"), F.col("drop").alias("__drop"))
        joined = docs.join(drops, docs[key].cast("long") == drops["__id"], "left").drop("__id")
        columns, min_chars = [*docs.columns, "__n_lines", "__n_dropped"], self.min_chars
        at, width = docs.columns.index(text), len(docs.columns)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, at):
                texts, kept, total, lost = part.column(at).cast(pa.binary()).to_pylist(), [], [], []
                for body, drop in zip(texts, part.column("__drop").to_pylist(), strict=True):
                    body = body or b""
                    total.append(body.count(b"\n") + 1)
                    lost.append(0)
                    if drop:
                        gone = set(drop)
                        lines = [line for line in body.split(b"\n") if digest(line, min_chars) not in gone]
                        lost[-1] = total[-1] - len(lines)
                        body = b"\n".join(lines)
                    kept.append(body)
                arrays = list(part.columns[:width])
                arrays[at] = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(total, pa.int64()), pa.array(lost, pa.int64())], names=columns)

        schema = StructType([*docs.schema.fields, StructField("__n_lines", LongType()), StructField("__n_dropped", LongType())])
        return joined.mapInArrow(run, schema)
