"""Token counts of documents in flat token files that have no index.

A file is token ids of fixed width one after another, each document closed by the end-of-document
id.  Files are cut into blocks at arbitrary places; numpy finds the separators of a block at once,
and a prefix scan over the few numbers known per block (ids, position of the last separator)
carries document starts over block borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrasse.llm.piece_codec import encoded_bytes
from terrasse.llm.viterbi import Pieces
from terrasse.settings import durable

BLOCK_BYTES = 1 << 20
FILE_RECORDS = 20_000


def width_of(pieces: Pieces) -> int:
    return 2 if len(pieces.texts) <= 1 << 16 else 4


def write_tokens(docs: DataFrame, path: str, model_file: str, text: str = "text") -> None:
    """Flat token files of ``docs``; a null or empty text is a document without tokens.

    Ids are little-endian, two bytes wide if the vocabulary allows.  Spark's text writer puts
    down the id bytes as they are and the end-of-document id as line separator, so the files
    reach any store that Spark writes to.
    """
    pieces = Pieces.load(model_file)
    width = width_of(pieces)
    separator = pieces.eos.to_bytes(width, "little").decode("latin-1")
    ids = encoded_bytes(docs.select(F.col(text).alias("text")), pieces, width)
    ids.select(F.col("ids").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", separator).option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _blocks(spark: SparkSession, path: str, block: int) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    parts = F.ceil(F.col("length") / block).cast("int") - 1
    cut = files.where("length > 0").select("path", "content", F.explode(F.sequence(F.lit(0), parts)).alias("block"))
    return cut.select("path", "block", F.expr(f"substring(content, block * {block} + 1, {block})").alias("bytes"))


def scan(spark: SparkSession, path: str, eod: int, width: int, block: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``path``, its number in the file ``nth`` from 0, first id ``start``, ``n_tokens``, ``closed``.

    Ids after the last separator are one more document that is not closed; two separators in a
    row hold an empty document.  A file is read as one value, so it may have 2 GB; blocks are what one step looks at.
    """
    if block % width:
        raise ValueError("a block must hold whole ids")
    kind = np.dtype(f"<u{width}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ends = [], []
            for body in batch.column("bytes"):
                ids = np.frombuffer(body.as_buffer(), kind)
                counts.append(len(ids))
                ends.append(np.flatnonzero(ids == eod))
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("block"), pa.array(counts, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                names=["path", "block", "n_ids", "ends"])

    found = durable(_blocks(spark, path, block).mapInArrow(search, "path string, block int, n_ids bigint, ends array<bigint>"), "separators")
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ids_before = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))
    placed = found.withColumn("offset", ids_before).withColumn("nth", F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)))
    last = F.when(F.size("ends") > 0, F.col("offset") + F.element_at("ends", -1))
    placed = placed.withColumn("last", last)
    placed = placed.withColumn("open", F.coalesce(F.max("last").over(earlier), F.lit(-1)) + 1)
    whole = placed.select("path", "nth", "offset", "open", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.col("offset") + F.expr("ends[i - 1]") + 1)
    whole = whole.select("path", (F.col("nth") + F.col("i")).alias("nth"), start.alias("start"), (F.col("offset") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    sums = placed.groupBy("path").agg(F.sum("n_ids").alias("ids"), F.sum(F.size("ends")).alias("nth"), F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"))
    rest = sums.where("ids > start").select("path", "nth", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    return whole.unionByName(rest)


def count_tokens(docs: DataFrame, path: str, model_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes ``docs`` as flat token files, scans them, and gives each document its id again.

    ``doc_id, part, nth, start, n_tokens``.  ``docs`` must be a plain scan: the files follow its
    partitions and rows, and so does the list of ids that is laid beside them.  Raises if the two disagree.
    """
    spark, pieces = docs.sparkSession, Pieces.load(model_file)
    write_tokens(docs, path, model_file, text)
    name = F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", 1).cast("int"), F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)", 2).cast("long")
    found = durable(scan(spark, path, pieces.eos, width_of(pieces)).select(
        name[0].alias("part"), (name[1] * FILE_RECORDS + F.col("nth")).alias("nth"), "start", "n_tokens", name[1].alias("file")), "documents")
    row = F.monotonically_increasing_id()
    ids = durable(docs.select(F.col(key).alias("doc_id"), F.shiftright(row, 33).cast("int").alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")), "ids")
    seen, listed = (x.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max("nth").alias("top")) for x in (found, ids))
    if seen.join(listed, ["part", "n", "top"], "full").count() != listed.count():
        raise RuntimeError("token files and documents differ; write docs out as a table first")
    return ids.join(found, ["part", "nth"]).select("doc_id", "part", "file", "nth", "start", "n_tokens")
