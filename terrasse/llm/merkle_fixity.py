"""Fixity of WARC replicas by Merkle trees.

A record's leaf is the SHA-256 of its bytes; a node covers a range of ``FANOUT`` times as many
bytes of its file as the level below and is the SHA-256 over the offsets and hashes of what starts in
that range, in offset order.  A file's root covers all its offsets.  Comparing two replicas starts at
the roots and goes down one level at a time, only into ranges whose hashes differ, so an audit of
sound replicas reads one root per file.

Nodes are made level by level, a group is at most ``FANOUT`` nodes (or what starts in
``LEAF_BYTES``), and every comparison is an equi-join on file and range.  SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrasse.settings import durable

LEAF_BYTES, FANOUT = 1 << 14, 16
FILE_RECORDS = 1000


def page_records(pages: DataFrame, records_per_file: int = FILE_RECORDS) -> DataFrame:
    """WARC resource records of a table ``page_id, url, html``: ``file, record, offset, length, payload``.

    ``record`` is the page id.  A file holds the pages of ``records_per_file`` consecutive ids, in order of id, then url and body; null
    urls and bodies count as empty, pages without id are in a file of their own, -1.
    """
    url, body = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    payload = F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")
    file = F.coalesce(F.floor(F.col("page_id") / records_per_file), F.lit(-1)).cast("long")
    rows = pages.select(file.alias("file"), F.col("page_id").cast("long").alias("record"), payload.alias("payload"))
    rows = rows.withColumn("length", F.octet_length("payload").cast("long"))
    # Only lengths are summed in a window; a file is bounded by its number of records.
    before = Window.partitionBy("file").orderBy("record", "payload").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select("file", "record", "offset", "length", "payload")


def leaves(records: DataFrame) -> DataFrame:
    """``file, offset, length, record, hash`` of records; a null payload is an empty one."""
    return records.select("file", "offset", "length", "record", F.sha2(F.coalesce("payload", F.lit(b"")), 256).alias("hash"))


def _up(below: DataFrame, at: Column) -> DataFrame:
    inside = F.array_sort(F.collect_list(F.struct("at", "hash")))
    text = F.concat_ws("|", F.transform(inside, lambda x: F.concat_ws(":", x["at"].cast("string"), x["hash"])))
    return below.groupBy("file", at.alias("range")).agg(F.sha2(text, 256).alias("hash"))


def tree(leaf: DataFrame, top: int) -> list[DataFrame]:
    """Levels ``file, range, hash`` from the finest ranges up to ``top`` levels above them."""
    level = durable(_up(leaf.select("file", F.col("offset").alias("at"), "hash"), F.floor(F.col("at") / LEAF_BYTES)), "ranges")
    levels = [level]
    for _ in range(top):
        level = durable(_up(level.select("file", F.col("range").alias("at"), "hash"), F.floor(F.col("at") / FANOUT)), "ranges")
        levels.append(level)
    return levels


def height(*replicas: DataFrame) -> int:
    """Levels above the finest ranges until one range spans the longest file."""
    last = max((r.agg(F.coalesce(F.max("offset"), F.lit(0))).first()[0] for r in replicas), default=0)
    n, width = 0, LEAF_BYTES
    while width <= last:
        n, width = n + 1, width * FANOUT
    return n


def _differing(left: DataFrame, right: DataFrame, within: DataFrame | None) -> DataFrame:
    if within is not None:
        parent = within.select("file", F.col("range").alias("parent"))
        left, right = (x.withColumn("parent", F.floor(F.col("range") / FANOUT)).join(parent, ["file", "parent"], "left_semi").drop("parent") for x in (left, right))
    both = left.join(right.withColumnRenamed("hash", "other"), ["file", "range"], "full")
    return both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "range")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records that differ: ``file, offset, length, record, fault`` (changed, missing, surplus), the primary's where it has one.

    Both inputs are records ``file, offset, length, record, payload``.  Records that stand at one
    offset twice are compared as a set; no differing record gives no row.
    """
    left, right = durable(leaves(primary), "leaves"), durable(leaves(replica), "leaves")
    top = height(left, right)
    a, b = tree(left, top), tree(right, top)
    bad = None
    for mine, theirs in zip(reversed(a), reversed(b), strict=True):
        bad = durable(_differing(mine, theirs, bad), "mismatch")
    inside = [x.withColumn("range", F.floor(F.col("offset") / LEAF_BYTES)).join(bad, ["file", "range"], "left_semi").groupBy("file", "offset").agg(
        F.min("length").alias("length"), F.min("record").alias("record"), F.array_sort(F.collect_list("hash")).alias("hashes")) for x in (left, right)]
    other = inside[1].select("file", "offset", F.col("length").alias("length2"), F.col("record").alias("record2"), F.col("hashes").alias("hashes2"))
    both = inside[0].join(other, ["file", "offset"], "full").where(~F.col("hashes").eqNullSafe(F.col("hashes2")))
    fault = F.when(F.col("hashes2").isNull(), "missing").when(F.col("hashes").isNull(), "surplus").otherwise("changed")
    return both.select("file", "offset", F.coalesce("length", "length2").alias("length"), F.coalesce("record", "record2").alias("record"), fault.alias("fault"))
