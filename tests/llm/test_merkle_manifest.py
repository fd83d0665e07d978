import hashlib

import pytest
from edge_cases import edge, nothing, rows_to_docs  # noqa: F401
from pyspark.sql import functions as F

from terrasse.llm import merkle_manifest as m


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in m.FIELDS))


def lift(nodes):
    return [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append(lift(out[-1]))
    return out


def siblings(tree, at):
    found = ""
    for level in tree[:-1]:
        run = at // 8 * 8
        found += "".join(h for i, h in enumerate(level[run : run + 8], run) if i != at)
        at //= 8
    return found


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf_of(r)))
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: levels([h for _, h in sorted(groups[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    return sorted(((i is not None, i), h, trees[k][-1][0], top[-1][0], digest(siblings(trees[k], at) + siblings(top, order.index(k))))
                  for k in order for at, (i, h) in enumerate(sorted(groups[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))))


def ours(frame):
    rows = m.verified(m.manifest(frame)).collect()
    assert all(r["verified"] for r in rows)
    return sorted(((r["doc_id"] is not None, r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in rows)


def with_langs(spark, langs):
    rows = [(i, f"text {i}", lang, None if i % 5 == 0 else "s", i) for i, lang in enumerate(langs)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("langs", [["en"], ["en"] * 8, ["en"] * 9, ["en"] * 65 + ["de"] * 8, ["en"] * 513 + [None] * 2 + [""] * 3, ["en"] * 1100 + [f"l{i}" for i in range(70)]])
def test_sizes_around_runs_and_blocks(spark, langs):
    frame = with_langs(spark, langs).repartition(3)
    assert ours(frame) == brute([r.asDict() for r in frame.collect()])


def test_more_rounds_than_blocks_need(spark, monkeypatch):
    monkeypatch.setattr(m, "LIFT", 1)
    monkeypatch.setattr(m, "BLOCK", 8)
    frame = with_langs(spark, ["en"] * 600 + ["de"] * 7)
    assert ours(frame) == brute([r.asDict() for r in frame.collect()])


def test_nulls_repeats_long_texts_and_clashing_names(spark, edge):  # noqa: F811
    frame = edge.withColumn("key", F.lit("clash")).withColumn("node", F.lit(1)).withColumn("segments", F.lit(2)).unionByName(
        edge.withColumn("key", F.lit("x")).withColumn("node", F.lit(1)).withColumn("segments", F.lit(2)).where("doc_id = 14"))
    assert ours(frame) == brute([r.asDict() for r in frame.collect()])
    long = rows_to_docs(spark, [(1, "é" * 1_000_000), (2, " " * 1_000_000), (3, None)])
    assert ours(long) == brute([r.asDict() for r in long.collect()])


def test_one_id_for_a_third_of_all_rows(spark):
    frame = rows_to_docs(spark, [(7 if i % 3 == 0 else i, "same" if i % 2 else "other") for i in range(700)])
    assert ours(frame) == brute([r.asDict() for r in frame.collect()])


def test_tampered_rows_do_not_verify(spark):
    frame = rows_to_docs(spark, [(i, f"Text {i}" if i % 4 else f"text {i}") for i in range(100)] + [(100, None)])
    rows = m.verified(m.manifest(frame, F.when(F.col("doc_id") % 2 == 0, F.lower("text")))).collect()
    assert {r["doc_id"] for r in rows if not r["verified"]} == {i for i in range(100) if i % 2 == 0 and i % 4}
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in rows) and len({r["root"] for r in rows}) == 1


def test_empty_table(nothing):  # noqa: F811
    assert m.verified(m.manifest(nothing)).count() == 0 and m.roots(nothing).count() == 0
