"""Merkle manifest of a table: a root over all rows and, for each row, the siblings that prove it.

Rows are leaves, each group of rows (a language) has a tree, and the roots of the groups are the
leaves of one more tree.  ``FANOUT`` consecutive nodes hash to one; the last run of a level may be
shorter.  Nodes stand in aligned blocks of 512, and a block keeps each of its levels as one string of
hex digests: a fixed-width substring of 8 digests is what a parent hashes, and what stands in that
substring left and right of a digest are its siblings.  A block rises three levels to one node; the
nodes of all blocks of a group are the leaves of the next round, until one is left.  A round divides the
rows by 512, so there are four rounds up to 68 billion rows in a group.

SQL functions only.  No task holds more than one block, so a group may hold all rows; what is kept of
a row between stages is its digests and id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.llm.positions import placed
from terrasse.settings import durable, durable_counted

FANOUT, LIFT, DIGEST = 8, 3, 64
BLOCK = FANOUT ** LIFT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = FANOUT * DIGEST


def digest_of(*values: Column) -> Column:
    """SHA-256 over fields that cannot run into one another: ``-`` for null, else the length in bytes, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*parts), 256)


def _runs(level: Column) -> Column:
    """The substrings of a level that a parent each hashes."""
    return F.transform(F.sequence(F.lit(0), F.ceil(F.length(level) / RUN).cast("int") - 1), lambda r: F.substring(level, r * RUN + 1, F.lit(RUN)))


def _blocks(nodes: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per block: its levels ``s0`` to ``s3`` as strings, as many as its group needs, and ``top``, its last level."""
    inside = F.array_sort(F.collect_list(F.struct("at", "node", *carry)))
    rows = nodes.groupBy("key", F.floor(F.col("at") / BLOCK).alias("block")).agg(F.max("size").alias("size"), inside.alias("inside"))
    rows = rows.withColumn("s0", F.array_join(F.col("inside.node"), ""))
    lift = F.when(F.col("size") <= 1, 0).when(F.col("size") <= FANOUT, 1).when(F.col("size") <= FANOUT**2, 2).otherwise(LIFT)
    rows = rows.withColumn("lift", lift)
    for k in range(LIFT):
        above = F.array_join(F.transform(_runs(F.col(f"s{k}")), lambda r: F.sha2(r, 256)), "")
        rows = rows.withColumn(f"s{k + 1}", F.when(F.col("lift") > k, above))
    return rows.withColumn("top", F.coalesce(*[f"s{k}" for k in range(LIFT, -1, -1)]))


def climb(nodes: DataFrame, largest: int, carry: Sequence[str] = ()) -> list[DataFrame]:
    """The stored blocks of every round, from leaves ``key, at, size, node`` up; the last round has one block per key.

    ``largest`` is the number of leaves of the largest key.  Columns of ``carry`` stay with the leaves.
    """
    rounds = [durable(_blocks(nodes, carry), "merkle")]
    while largest > BLOCK:
        largest = -(-largest // BLOCK)
        up = rounds[-1].select("key", F.col("block").alias("at"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("top").alias("node"))
        rounds.append(durable(_blocks(up, ()), "merkle"))
    return rounds


def _segments(at: Column) -> Column:
    """Siblings of the node at place ``at`` of a block on each of the block's levels: left ones, right ones."""

    def one(k: int) -> Column:
        place = F.shiftright(at, 3 * k)
        run = F.substring(F.col(f"s{k}"), F.shiftright(place, 3) * RUN + 1, F.lit(RUN))
        mine = place % FANOUT * DIGEST
        return F.when(F.col("lift") > k, F.struct(F.substring(run, F.lit(1), mine).alias("left"), F.substring(run, mine + DIGEST + 1, F.lit(RUN)).alias("right")))

    return F.filter(F.array(*[one(k) for k in range(LIFT)]), lambda s: s.isNotNull())


def descend(rounds: list[DataFrame], above: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Leaves ``key, at, node`` with ``carry``, the columns of ``above``, and all their siblings up to the root in ``segments``.

    ``above`` has one row per key: ``key, segments`` and what else each leaf of the key is to have.
    """
    extra = [c for c in above.columns if c not in ("key", "segments")]
    known = above.withColumn("block", F.lit(0).cast("long"))
    for step, blocks in reversed(list(enumerate(rounds))):
        kept = ["at", "node", *(carry if step == 0 else ())]
        # One row per block meets the path above it, before its nodes become rows.
        both = blocks.join(known, ["key", "block"]).select("key", "block", "lift", *[f"s{k}" for k in range(LIFT)], "segments", *extra, F.explode("inside").alias("x"))
        mine = F.concat(_segments((F.col("x.at") % BLOCK).cast("int")), F.col("segments"))
        known = both.select("key", *[F.col(f"x.{c}").alias(c) for c in kept], mine.alias("segments"), *extra)
        if step:
            known = known.select("key", F.col("at").alias("block"), "segments", *extra)
    return known


def proof_text(segments: Column) -> Column:
    """All siblings in the order of a proof."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segments, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(docs: DataFrame, suspect: Column | None = None) -> DataFrame:
    """Per row ``doc_id, lang, leaf, suspect, subroot, root, segments``.

    ``suspect`` is a second text that some rows are to be checked with (null: the row's own); its leaf is
    in column ``suspect``, else null.  Leaves of a language ascend by doc_id (null first), those of one id by digest, so rows equal in all fields are
    neighbours.  A null language is a group of its own, the first; a null field counts as ``-``.
    An empty table has no rows and no root; further columns are not read.
    """
    fields = [F.col(f) for f in FIELDS]
    other = F.when(suspect.isNotNull(), digest_of(*[suspect if f == "text" else F.col(f) for f in FIELDS])) if suspect is not None else F.lit(None).cast("string")
    # "=" keeps a language apart from a missing one, which sorts first.
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    leaves, n = durable_counted(docs.select(
        key.alias("key"), F.col("doc_id"), digest_of(*fields).alias("node"), other.alias("suspect"), F.monotonically_increasing_id().alias("__row")), "leaves")
    carry = ["doc_id", "suspect"]
    nodes = placed(leaves, n, ["key"], ["doc_id", "node", "__row"]).drop("__row")
    rounds = climb(nodes, n, carry)
    subroots, n_keys = durable_counted(rounds[-1].select(F.col("key").alias("lang_key"), F.col("top").alias("node")), "subroots")
    top = climb(placed(subroots.withColumn("key", F.lit("")), n_keys, ["key"], ["lang_key"]), n_keys, ["lang_key"])
    root = top[-1].select("key", F.array().cast("array<struct<left:string,right:string>>").alias("segments"), F.col("top").alias("root"))
    above = descend(top, root, ["lang_key"]).select(F.col("lang_key").alias("key"), "segments", F.col("node").alias("subroot"), "root")
    rows = descend(rounds, durable(above, "above"), carry)
    lang = F.when(F.col("key") != "", F.expr("substring(key, 2)"))
    return rows.select("doc_id", lang.alias("lang"), F.col("node").alias("leaf"), "suspect", "subroot", "root", "segments")


def roots(docs: DataFrame) -> DataFrame:
    """``lang, subroot, root`` of a table, without proofs: what two copies of it are compared by."""
    return manifest(docs).groupBy("lang").agg(F.first("subroot").alias("subroot"), F.first("root").alias("root"))


def verified(rows: DataFrame) -> DataFrame:
    """Rows of `manifest` with their proof's digest, the root that the suspect or own leaf folds to, and whether that is the root."""
    folded = fold(F.coalesce("suspect", "leaf"), F.col("segments"))
    rows = rows.withColumns({"proof_sha256": F.sha2(proof_text(F.col("segments")), 256), "folded_root": folded})
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
