import re
from collections import Counter

from conftest import rows
from edge_cases import edge, nothing  # noqa: F401

from terrasse.llm import quality_ledger as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {p for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_measures_match_brute_force(edge):
    got = q.ledger(edge).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    want = [(r["doc_id"], *brute(r["text"])) for r in edge.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_verdicts_and_policies(spark, edge):
    docs = spark.createDataFrame([(1, "good words here and there " * 5 + " ".join(f"w{i}" for i in range(60))), (2, "a### b$$$ " + " ".join(f"w{i}" for i in range(60))), (3, " ".join(f"SHOUT{i}" for i in range(60)))], "doc_id long, text string")
    got = {r["doc_id"]: (r["fail_bits"], r["kept"]) for r in q.apply_policy(q.ledger(docs)).collect()}
    assert got[1] == (0, True) and got[2] == (0, True) and got[3] == (1 << 3, False)
    kept = {r["doc_id"] for r in q.apply_policy(q.ledger(docs), "base").where("kept").collect()}
    assert kept == {1, 2, 3}
    assert sorted(r["doc_id"] for r in q.keep_documents(docs).collect()) == [1, 2]


def test_ablations_agree_with_the_ledger(edge):
    ledger = q.ledger(edge)
    bits = [r["fail_bits"] for r in ledger.collect()]
    found = q.ablations(ledger).collect()
    assert len(found) == sum(m.bit_count() for m in q.POLICIES.values())
    for r in found:
        mask = q.POLICIES[r["policy"]]
        assert r["documents"] == len(bits) and r["kept"] == sum(not b & mask for b in bits)
        assert r["failing"] == sum(bool(b & r["bit"]) for b in bits)
        assert r["failing_only"] == sum(b & mask == r["bit"] for b in bits)
        assert r["kept_without"] == sum(not b & mask & ~r["bit"] for b in bits)


def test_filter_keeps_columns_and_agrees_with_the_policy(edge, nothing):
    kept = q.keep_documents(edge)
    assert kept.columns == edge.columns
    want = q.apply_policy(q.ledger(edge)).where("kept").select("doc_id")
    assert rows(kept, "doc_id") == rows(want)
    assert q.keep_documents(nothing).count() == q.ledger(nothing).count() == q.ablations(q.ledger(nothing)).count() == 0
