"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A (byte-level) encodes a space and the text, tokenizer B (pieces) the text, to which it adds
that space itself.  Where tokens of both end at one byte, the text is cut into groups; an A and a B token whose
byte ranges overlap are linked.  An id pair's count is the number of documents of the whole corpus in which it is
linked, and the best pairs of an A id are those of its highest count.

Everything within a slice of texts is Arrow: lists are flattened with their parents' indices, byte ends are
cumulative sums within a document, a hash join on (document, end) tells common ends from others, and in order of end
each row of that join is one link, because between two neighbouring ends lies exactly one token of either side.
`Table.group_by` counts pairs per slice.  Spark adds the counts up, gives every slice those of its own pairs, and the
documents of a slice are then summed against them, so no table of all pairs goes anywhere and no link is a row.

Tokenizer files are broadcast as they are (some megabytes).  Slices hold ``SLICE_BYTES`` of text and one text at least;
a text needs some hundred times its bytes while it is aligned, and its groups as text must fit one value of 2 GB.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrasse.llm.words import plain, slices
from terrasse.settings import durable

SLICE_BYTES = 2 << 20
A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"

# Fixed value: how byte-level vocabularies of this kind cut words.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_TEXT = 100_000  # characters

FIGURES = ("n_a", "n_b", "n_groups", "n_links")
ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, slots array<int>, times array<int>, batch long, pairs array<long>, holders array<int>"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class TokenizerPair:
    """The two models from their files' bytes; built once in each worker."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        self.files = a_file, b_file

    @classmethod
    def load(cls, a_path: str = A_FILE, b_path: str = B_FILE) -> TokenizerPair:
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            return cls(a.read(), b.read())

    def __getstate__(self) -> dict:
        return {"files": self.files}

    @cached_property
    def a(self):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        model = Tokenizer.from_str(self.files[0].decode())
        model.encode_special_tokens = True
        return model

    @cached_property
    def a_ranks(self):
        """The same model by ranks, several times as fast; None unless its ids are the ranks of its merges and words are cut by the usual pattern."""
        import tiktoken

        spec, alphabet = json.loads(self.files[0]), byte_alphabet()
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        vocabulary = model["vocab"]
        made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        plain_cut = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and spec.get("normalizer") is None
        if not plain_cut or made != sorted(made) or model.get("ignore_merges") or any(c not in vocabulary for c in alphabet):
            return None
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(alphabet[c] for c in entry): i for entry, i in vocabulary.items() if entry not in special}
        return tiktoken.Encoding("byte-level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.files[1])

    @cached_property
    def a_bytes(self) -> pa.Array:
        """Bytes of every A id."""
        spec, alphabet = json.loads(self.files[0]), byte_alphabet()
        entries = {i: bytes(alphabet[c] for c in entry) for entry, i in spec["model"]["vocab"].items() if all(c in alphabet for c in entry)}
        entries |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", ())}
        return pa.array([entries.get(i, b"") for i in range(max(entries) + 1)], pa.binary())

    @cached_property
    def b_bytes(self) -> pa.Array:
        ids = range(self.b.get_piece_size())
        return pa.array([bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ids], pa.binary())

    def encode_a(self, text: str) -> np.ndarray:
        """A's ids of a space and the text.  Very long texts take the slower way: a long run of spaces would end the pattern search of the other."""
        if self.a_ranks is not None and len(text) <= LONG_TEXT:
            return self.a_ranks.encode_to_numpy(" " + text, disallowed_special=())
        return np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        said = texts.to_pylist()
        return _lists([self.encode_a(t) for t in said]), _lists([np.array(x, np.int32) for x in self.b.encode(said, num_threads=1)])


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
    return pa.ListArray.from_arrays(pa.array(_starts(ends).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)))


def joined_bytes(ids: pa.ListArray, vocabulary: pa.Array) -> pa.Array:
    """The bytes of each list's tokens, one after the other: the tokens' own buffer, cut at the lists' starts."""
    flat = pc.list_flatten(ids)
    tokens = vocabulary.take(flat)
    ends = np.frombuffer(tokens.buffers()[1], np.int32)[: len(tokens) + 1] if len(tokens) else np.zeros(1, np.int32)
    starts = ids.offsets.to_numpy() - ids.offsets[0].as_py()
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(ends[starts])), tokens.buffers()[2] or pa.py_buffer(b"")])


def _ends(ids: pa.ListArray, vocabulary: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each token's (document, end) key, the end counted in bytes from its document's start, and its id."""
    flat, doc = pc.list_flatten(ids), pc.cast(pc.list_parent_indices(ids), pa.int64())
    upto = pc.cumulative_sum(pc.cast(pc.take(pc.binary_length(vocabulary), flat), pa.int64()))
    starts = pa.array(ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py())
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), upto]), starts)
    end = pc.subtract(upto, pc.take(before, doc))
    return pc.add(pc.shift_left(doc, 32), end), flat


def _joined(cells: pa.Array, starts: np.ndarray, by: str) -> pa.Array:
    """Runs of text cells joined to one text each."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), cells), by)


def _starts(last: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), last))


def align(a: pa.ListArray, b: pa.ListArray, pair: TokenizerPair) -> tuple[np.ndarray, pa.Array, pa.Table]:
    """Of documents whose tokens give the same bytes: groups per document, groups as text, links ``doc, pair`` in order."""
    a_key, a_id = _ends(a, pair.a_bytes)
    b_key, b_id = _ends(b, pair.b_bytes)
    both = pa.table({"key": a_key, "a": a_id}).join(pa.table({"key": b_key, "b": b_id}), "key", join_type="full outer", use_threads=False).combine_chunks()
    both = both.take(pc.sort_indices(both.column("key")))
    is_a, is_b = (pc.cast(pc.is_valid(both.column(c)), pa.int64()).combine_chunks().to_numpy() for c in ("a", "b"))
    a_upto, b_upto, doc = np.cumsum(is_a), np.cumsum(is_b), both.column("key").to_numpy() >> 32
    common = np.flatnonzero(is_a & is_b)
    # A link's tokens are the first of either side that end at or after it.
    pairs = pc.add(pc.shift_left(pc.cast(a_id.take(pa.array(a_upto - is_a)), pa.int64()), 32), pc.cast(b_id.take(pa.array(b_upto - is_b)), pa.int64()))
    sides = [_joined(pc.cast(x, pa.string()), _starts(upto[common]), ",") for x, upto in ((a_id, a_upto), (b_id, b_upto))]
    n_groups = np.bincount(doc[common], minlength=len(a))
    groups = _joined(pc.binary_join_element_wise(*sides, "|"), _starts(np.cumsum(n_groups)), ";")
    return n_groups, groups, pa.table({"doc": doc, "pair": pairs})


def _by_row(n_rows: int, rows: np.ndarray, lists: np.ndarray) -> pa.Array:
    """Offsets of ``n_rows`` lists of which only ``rows`` have members, as many as ``lists`` says."""
    size = np.zeros(n_rows, np.int64)
    size[rows] = lists
    return pa.array(_starts(np.cumsum(size)).astype(np.int32))


def _align_slice(part: pa.RecordBatch, pair: TokenizerPair, batch: int) -> pa.RecordBatch:
    n, texts = part.num_rows, plain(part.column("text"))
    a, b = pair.encode(texts)
    meant = pc.binary_join_element_wise("", texts, " ").cast(pa.binary())
    same = pc.and_(pc.equal(joined_bytes(a, pair.a_bytes), meant), pc.equal(joined_bytes(b, pair.b_bytes), meant))
    good = np.flatnonzero(pc.and_(same, pc.greater(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False))
    figures, groups = {f: np.zeros(n, np.int64) for f in FIGURES}, pa.array([""] * n)
    slots = times = pairs = holders = pa.array([], pa.int32())
    offsets = _by_row(n, good[:0], good[:0])
    if len(good):
        a, b = a.take(pa.array(good)), b.take(pa.array(good))
        n_groups, text, links = align(a, b, pair)
        held = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by([("doc", "ascending"), ("pair", "ascending")]).combine_chunks()
        counts = held.group_by("pair", use_threads=False).aggregate([([], "count_all")]).combine_chunks()
        pairs, holders = counts.column("pair").chunk(0), counts.column("count_all").chunk(0)
        slots, times = pc.index_in(held.column("pair").chunk(0), value_set=pairs), held.column("count_all").chunk(0)
        offsets = _by_row(n, good, np.bincount(held.column("doc").to_numpy(), minlength=len(good)))
        made = (pc.list_value_length(a).to_numpy(), pc.list_value_length(b).to_numpy(), n_groups, np.bincount(links.column("doc").to_numpy(), minlength=len(good)))
        for name, values in zip(FIGURES, made, strict=True):
            figures[name][good] = values
        at = np.zeros(n, np.int64)
        at[good] = np.arange(1, len(good) + 1)
        groups = pa.concat_arrays([pa.array([""]), text]).take(pa.array(at))
    # The pairs of a slice and how many of its documents hold each stand in its first row.
    first = pa.array(np.concatenate((np.zeros(1, np.int32), np.full(n, len(pairs), np.int32))))
    mask = pa.array(np.arange(n) > 0)
    lists = [pa.ListArray.from_arrays(offsets, x.cast(pa.int32())) for x in (slots, times)]
    known = [pa.ListArray.from_arrays(first, x.cast(kind), mask=mask) for x, kind in ((pairs, pa.int64()), (holders, pa.int32()))]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), *[pa.array(figures[f]) for f in FIGURES], groups, *lists, pa.array(np.full(n, batch)), *known],
        names=["doc_id", *FIGURES, "groups", "slots", "times", "batch", "pairs", "holders"])


def aligned(docs: DataFrame, pair: TokenizerPair) -> DataFrame:
    """Per document its figures, ``groups`` as ``a1,a2|b1;a3|b2,b3``, and its distinct links as slots of its slice's pairs.

    ``batch`` names the slice; one row of each has its ``pairs`` (A id in the upper half) and the number of documents that hold them.
    Batch numbers follow the input's partitions: write the rows before they are read twice.
    """
    known = docs.sparkSession.sparkContext.broadcast(pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for i, part in enumerate(slices(batches, limit=SLICE_BYTES)):
            yield _align_slice(part, known.value, base + i)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROW)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, count, best`` over the whole corpus, from the counts of the slices; an A id has at most as many pairs as B has ids."""
    counts = _slice_pairs(rows).groupBy("pair").agg(F.sum("holders").alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.withColumn("best", F.col("count") == highest)


def _slice_pairs(rows: DataFrame) -> DataFrame:
    cells = F.posexplode(F.arrays_zip("pairs", "holders")).alias("slot", "x")
    return rows.where(F.col("pairs").isNotNull()).select("batch", cells).select("batch", "slot", F.col("x.pairs").alias("pair"), F.col("x.holders").cast("long").alias("holders"))


def _sums(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Documents of a slice against the corpus counts of its pairs."""
    docs = docs.drop_columns(["batch"]).combine_chunks()
    known = known.take(pc.sort_indices(known.column("slot"))).combine_chunks()
    slots, times = (docs.column(c).combine_chunks() for c in ("slots", "times"))
    at, times = pc.list_flatten(slots), pc.cast(pc.list_flatten(times), pa.int64())
    links = pa.table({
        "doc": pc.list_parent_indices(slots), "best": pc.multiply(times, pc.cast(known.column("best"), pa.int64()).take(at)), "sum": pc.multiply(times, known.column("count").take(at))})
    per = links.group_by("doc", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
    place = pc.index_in(pa.array(np.arange(docs.num_rows)), value_set=per.column("doc").cast(pa.int64()))
    found = [pc.fill_null(per.column(c).take(place), 0) for c in ("best_sum", "sum_sum")]
    return docs.drop_columns(["slots", "times"]).append_column("n_best", found[0]).append_column("count_sum", found[1])


def alignments(docs: DataFrame, pair: TokenizerPair, groups: str = "groups") -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` and its groups.

    ``groups="digest"`` keeps the SHA-256 of the groups instead of the text, in ``groups_sha256``.  A text that is null, empty
    or not what either tokenizer's tokens spell has no tokens: zeros and an empty text, which is not hashed.  Rows of one doc_id are
    documents of their own, a null doc_id is kept, further columns are not read, an empty table gives an empty table.
    """
    rows = aligned(docs, pair)
    if groups == "digest":
        rows = rows.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    shown = "groups_sha256" if groups == "digest" else "groups"
    rows = durable(rows, "aligned")
    known = _slice_pairs(rows).select(F.col("batch").alias("of_batch"), "slot", "pair").join(pair_counts(rows), "pair").select("of_batch", "slot", "count", "best")
    mine = rows.select("doc_id", *FIGURES, shown, "slots", "times", "batch")
    out = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {shown} string, n_best long, count_sum long"
    return mine.groupBy("batch").cogroup(known.groupBy("of_batch")).applyInArrow(_sums, out)
