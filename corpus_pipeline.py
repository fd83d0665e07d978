"""From raw documents to token ids: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that the one before kept, and
its decisions take effect.  `run` writes every stage as Parquet in the shared folder and reads it
again as the next one's input, so a lost executor costs one stage at most.

Documents may hold nulls in any column, repeated rows and other columns besides: a null text is
an empty one, rows of one id are one document, further columns are carried along, and an empty
table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasse.llm import line_ledger, near_copies, piece_codec, quality_ledger, string_tiling
from terrasse.llm.viterbi import Pieces
from terrasse.settings import durable, fresh_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger keeps."""
    return quality_ledger.keep_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents share; ``n_chars`` is counted anew where lines went."""
    ledger = line_ledger.LineLedger(spark, fresh_path(spark, "line-ledger"))
    ledger.insert(docs)
    cleaned, columns = ledger.clean(docs), docs.columns
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("__n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cleaned.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more."""
    return near_copies.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return string_tiling.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of the text, their number, and whether they decode to the text."""
    pieces = Pieces.load(piece_codec.MODEL)
    rows = piece_codec.encode_documents(docs.select("doc_id", "text"), pieces, proof="round_trip")
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("encode", encode)]

# Fingerprints and ids of pieces are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
