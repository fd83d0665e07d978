"""Edge lists: symmetric pair joins, bounded closure, hierarchies, lineage.

Every step is one equi join.  Each level is written out before the next one reads it, so the
plan stays short and a lost executor costs one level at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasse.settings import durable, durable_counted


def pair_key(a: str, b: str):
    """Order-free key of a pair; NULL when either side is NULL."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    return F.when(both, F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")))


def symmetric_pair_join(
    opened: DataFrame, closed: DataFrame, a: str, b: str, opened_at: str, closed_at: str, mode: str = "first_after"
) -> DataFrame:
    """Left join where (a, b) meets (a, b) or (b, a).

    Only the first close after the open row counts.  ``mode="all"`` keeps every match, which for a pair that
    opens m times and closes n times is m x n rows.
    """
    left = opened.withColumn("__pair", pair_key(a, b))
    right = closed.select(pair_key(a, b).alias("__pair"), F.col(closed_at).alias("valid_to")).filter(
        F.col("__pair").isNotNull()
    )
    if mode == "all":
        joined = left.join(right, "__pair", "left")
    elif mode == "first_after":
        joined = _first_close(left, right, opened_at)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined.drop("__pair").withColumn("is_current", F.col("valid_to").isNull())


def _first_close(left: DataFrame, right: DataFrame, opened_at: str) -> DataFrame:
    """First close strictly after each open row, by one ordered pass instead of a join."""
    from terrasse.operators.ordered import over_order

    # Latest time first: the last close seen so far is the nearest one after the row.
    opens = left.withColumns({"__close": F.lit(None).cast(right.schema["valid_to"].dataType), "__rank": F.lit(1)})
    opens = opens.withColumn("__at", -F.unix_micros(F.col(opened_at).cast("timestamp")))
    closes = right.select("__pair", F.col("valid_to").alias("__close"), F.lit(2).alias("__rank")).withColumn(
        "__at", -F.unix_micros(F.col("__close").cast("timestamp"))
    )
    timeline = opens.filter(F.col("__pair").isNotNull()).unionByName(closes, allowMissingColumns=True)
    # At one time a close sorts behind the opens, so it does not end a row opened at that moment.
    ordered = over_order(timeline, ["__pair"], ["__at", "__rank"], last={"valid_to": "__close"})
    out = ordered.filter(F.col("__rank") == 1).drop("__close", "__rank", "__at")
    alone = left.filter(F.col("__pair").isNull()).withColumn("valid_to", F.lit(None).cast(right.schema["valid_to"].dataType))
    return out.unionByName(alone)


def closure(edges: DataFrame, parent: str = "ancestor_id", child: str = "descendant_id", max_depth: int = 5) -> DataFrame:
    """All (ancestor, descendant) pairs with their smallest depth, up to ``max_depth``.

    Duplicate edges and self pairs are dropped.  Further columns of ``edges`` (one value per
    edge, such as a time) follow the first edge below the descendant's own parent.
    """
    extra = [c for c in edges.columns if c not in {parent, child}]
    value = [F.min(F.struct(*extra)).alias("__extra")] if extra else []
    pick = ["__extra"] if extra else []

    base = edges.filter(F.col(parent).isNotNull() & F.col(child).isNotNull() & (F.col(parent) != F.col(child)))
    base = base.groupBy(parent, child).agg(*value) if extra else base.select(parent, child).distinct()
    base = durable(base, "edges")
    levels = [base.withColumn("generation_depth", F.lit(1))]
    frontier = levels[0]
    up = base.select(F.col(parent).alias("__up"), F.col(child).alias("__via"))

    for depth in range(2, max_depth + 1):
        step = (
            frontier.join(up, frontier[parent] == up["__via"])
            .filter(F.col("__up") != F.col(child))
            .select(F.col("__up").alias(parent), child, *pick)
        )
        step = step.groupBy(parent, child).agg(F.min("__extra").alias("__extra")) if extra else step.distinct()
        known = reduce(DataFrame.unionByName, [lv.select(parent, child) for lv in levels])
        fresh = step.join(known, [parent, child], "left_anti").withColumn("generation_depth", F.lit(depth))
        frontier, found = durable_counted(fresh, f"level-{depth}")
        if not found:
            break
        levels.append(frontier)
    pairs = reduce(DataFrame.unionByName, levels)
    return pairs.select(parent, child, *[F.col("__extra").getField(c).alias(c) for c in extra], "generation_depth")


def mirror_edges(pairs: DataFrame, a: str, b: str, forward: str, backward: str, kind: str = "relation_type") -> DataFrame:
    """Both directions of every edge, from one scan."""
    rest = [c for c in pairs.columns if c not in {a, b}]
    def edge(x, y, label):
        return F.struct(F.col(x).alias("person_id_a"), F.col(y).alias("person_id_b"), F.lit(label).alias(kind))
    both = F.explode(F.array(edge(a, b, forward), edge(b, a, backward)))
    return pairs.select(both.alias("__e"), *rest).select("__e.*", *rest)


def resolve_hierarchy(
    codes: DataFrame,
    identifier: str = "identifier",
    parent: str = "parent",
    level: str = "type",
    top: str = "KAPITTEL",
    middle: str = "BLOKK",
    max_depth: int = 32,
) -> DataFrame:
    """Add ``chapter_code`` and ``block_code`` by walking the parent pointers.

    A top row names itself; a middle row names its direct parent; every other row finds the
    nearest middle row on the way and the first top row above it.  A walk stops at a top row, at an
    unknown parent or when it meets a node again; one longer than ``max_depth`` raises.

    Only nodes that are somebody's parent are walked; the codes themselves meet the resolved
    parents in one join.
    """
    parents = codes.select(F.col(parent).alias("__node")).where(F.col("__node").isNotNull()).distinct()
    known = codes.select(F.col(identifier).alias("__node"), F.col(level).alias("__level"), F.col(parent).alias("__parent"))
    nodes = known.join(parents, "__node", "left_semi").groupBy("__node").agg(F.max(F.struct("__level", "__parent")).alias("__n"))
    nodes = durable(nodes.select("__node", "__n.*"), "nodes")

    walk = nodes.select(
        F.col("__node").alias("__start"), F.col("__node").alias("__at"), F.lit(None).cast("string").alias("__block"),
        F.array(F.lit(None).cast(codes.schema[identifier].dataType)).alias("__seen"),
    )
    finished = []
    for _ in range(max_depth):
        met = walk.join(nodes, F.col("__at") == F.col("__node"), "left")
        step = met.select(
            "__start",
            F.coalesce("__block", F.when(F.col("__level") == middle, F.col("__at").cast("string"))).alias("__block"),
            F.when(F.col("__level") == top, F.col("__at").cast("string")).alias("__chapter"),
            F.array_append("__seen", F.col("__at")).alias("__seen"),
            F.col("__parent").alias("__at"),
        )
        ended = (
            F.col("__chapter").isNotNull()
            | F.col("__at").isNull()
            | F.coalesce(F.array_contains("__seen", F.col("__at")), F.lit(False))
        )
        step = durable(step.withColumn("__ended", ended), "walk")
        finished.append(step.filter("__ended"))
        walk = step.filter("NOT __ended").drop("__ended")
        if walk.isEmpty():
            break
    else:
        raise ValueError(f"a code lies more than {max_depth} levels below its top")
    found = reduce(DataFrame.unionByName, finished).select(F.col("__start").alias("__p"), F.col("__chapter"), F.col("__block"))
    own = F.col(level)
    return codes.join(found, F.col(parent) == F.col("__p"), "left").select(
        *codes.columns,
        F.when(own == top, F.col(identifier).cast("string"))
        .when(own == middle, F.col(parent).cast("string"))
        .otherwise(F.col("__chapter"))
        .alias("chapter_code"),
        F.when(~own.isin(top, middle) | own.isNull(), F.col("__block")).alias("block_code"),
    )


def lineage(products: DataFrame, product: str = "product_id", sources: str = "source_products", max_depth: int = 5) -> DataFrame:
    """(product, related, direction, depth): all sources up to ``max_depth`` and direct consumers."""
    edges = products.select(F.col(product).alias("descendant_id"), F.explode(sources).alias("ancestor_id"))
    edges = edges.filter(F.col("ancestor_id") != F.col("descendant_id"))
    upstream = closure(edges, max_depth=max_depth).select(
        F.col("descendant_id").alias(product),
        F.col("ancestor_id").alias("related_id"),
        F.lit("upstream").alias("direction"),
        F.col("generation_depth").alias("depth"),
    )
    consumers = edges.select(
        F.col("ancestor_id").alias(product), F.col("descendant_id").alias("related_id"),
        F.lit("downstream").alias("direction"), F.lit(1).alias("depth"),
    ).distinct()
    return upstream.unionByName(consumers)
