import corpus_pipeline as cp
import pytest
from conftest import plan
from edge_cases import edge, nothing, prose, rows_to_docs  # noqa: F401
from test_line_ledger import brute as lines_brute
from test_near_copies import kept
from test_quality_ledger import brute as words_brute

import __spark_entry__ as driver
from terrasse.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(0, prose(70, 30))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_against_brute_force(spark, folder):
    shared = "This boilerplate line stands in every one of the documents."
    body = [(i, prose(100 + i, 80) + "\n" + shared) for i in range(8)]
    docs = body + [(20, body[0][1]), (21, prose(60, 200) + " " + prose(70, 30)), (22, "bad### junk$$$ " * 60), (23, None), (24, "too short"), (26, prose(200, 90)), (27, prose(200, 90))]
    frame = rows_to_docs(spark, docs)
    good = cp.quality(spark, frame, folder)
    assert {r["doc_id"] for r in good.collect()} == {i for i, t in docs if words_brute(t)[0] >= 50 and i != 22}
    lined = cp.lines(spark, good, folder).collect()
    dropped = {r[0]: r[2] for r in lines_brute([(r["doc_id"], r["text"]) for r in good.collect()])}
    before = {r["doc_id"]: r["text"] for r in good.collect()}
    for r in lined:
        assert before[r["doc_id"]].count("\n") - r["text"].count("\n") == dropped[str(r["doc_id"])]
        assert r["n_chars"] == len(r["text"]) and r["n_words"] == "clash"
    near = cp.near_duplicates(spark, rows_to_docs(spark, [(r["doc_id"], r["text"]) for r in lined]), folder)
    want = kept([(r["doc_id"], r["text"]) for r in lined])
    assert {r["doc_id"] for r in near.collect()} == want and 0 in want and not {20, 27} & want
    clean = cp.decontaminate(spark, near, folder)
    assert 21 not in {r["doc_id"] for r in clean.collect()} and clean.count() == near.count() - 1
    coded = cp.encode(spark, clean, folder)
    assert coded.count() == clean.count() and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in coded.collect())


def test_edge_documents_pass_every_stage(spark, edge, nothing, folder):
    for start in (edge, nothing):
        docs = start
        for name, stage in cp.STAGES:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns or name == "encode"
            docs = out
        assert docs.where("not round_trip").count() == 0
    assert cp.lines(spark, edge, folder).count() == edge.count()
    assert cp.encode(spark, edge, folder).count() == edge.count()


def test_all_queries_are_registered(spark):
    names = driver.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES) and set(queries.ORACLES) <= set(driver.oracle_sql())
    assert [s[0] for s in cp.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "encode"]


def test_run_on_the_smoke_tables(spark):
    out = cp.run(spark, driver.SMOKE_DIR)
    assert 0 < out.count() < 200 and out.where("not round_trip").count() == 0
    assert "Join" not in plan(out)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    from oracle import compare, connect

    ok, note = compare(spark, connect(driver.SMOKE_DIR), driver.SMOKE_DIR, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, note
