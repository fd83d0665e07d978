"""Encoding and decoding of whole tables with the streaming Viterbi of `viterbi`."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from terrasse.llm.viterbi import Encoder, Pieces, decode_lists
from terrasse.llm.words import plain, slices

SLICE_BYTES = 1 << 20  # encoding needs some hundred bytes of arrays for each byte of distinct words
MODEL = os.path.join("/opt/tokenizers", "piece_bpe_32k.model")


def encode_documents(docs: DataFrame, pieces: Pieces, text: str = "text", out: str = "ids", proof: str | None = None) -> DataFrame:
    """``docs`` with all columns and the ids of each text; null and empty texts have an empty list.

    ``proof`` names a further column that says whether the ids decode to the text again.  The
    vocabulary (one model file) goes to every task; columns named like the new ones are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(pieces)
    made = [StructField(out, ArrayType(IntegerType()))] + ([StructField(proof, BooleanType())] if proof else [])
    docs = docs.drop(*[f.name for f in made])
    at, names = docs.columns.index(text), [*docs.columns, *[f.name for f in made]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(known.value)
        for part in slices(batches, at, SLICE_BYTES):
            starts, ids = encoder.encode(part.column(at))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
            extra = [pc.equal(decode_lists(known.value, lists), plain(part.column(at)))] if proof else []
            yield pa.RecordBatch.from_arrays([*part.columns, lists, *extra], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *made]))


def encoded_bytes(texts: DataFrame, pieces: Pieces, width: int) -> DataFrame:
    """The ids of a column ``text`` as little-endian bytes, row by row, in a column ``ids``."""
    known, kind = texts.sparkSession.sparkContext.broadcast(pieces), f"<u{width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(known.value)
        for part in slices(batches, limit=SLICE_BYTES):
            starts, ids = encoder.encode(part.column("text"))
            body = pa.py_buffer(ids.astype(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((starts * width).astype(np.int32)), body])], names=["ids"])

    return texts.select("text").mapInArrow(run, "ids binary")


def decode_documents(rows: DataFrame, pieces: Pieces, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with all columns and the text of each list of ids; a null list stays null."""
    known = rows.sparkSession.sparkContext.broadcast(pieces)
    rows = rows.drop(out)
    at, names = rows.columns.index(ids), [*rows.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_lists(known.value, part.column(at))], names=names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(out, StringType())]))
