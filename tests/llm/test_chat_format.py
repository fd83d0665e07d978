import random

import pytest
from conftest import plan
from pyspark.sql import functions as F

from terrasse.llm import chat_format as m
from terrasse.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, n string, part string, segments string, verdict int"


def frame(spark, rows):
    """Turns with further columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, "clash", "clash", "clash", 1) for r in rows], SCHEMA)


def brute(rows, template=m.CHATML):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns = [(r, t) for _, r, t in sorted(turns)]
        state, bad = template.start, None
        for i, (role, _) in enumerate(turns, 1):
            if role not in template.moves[state]:
                bad = i
                break
            state = template.moves[state][role]
        out[c] = (turns, "order" if bad else "ok" if state in template.final else "open", bad)
    return out


def check(spark, rows, template=m.CHATML):
    got = m.conversations(frame(spark, rows), template).withColumn("formatted", m.formatted(F.col("segments")))
    got = {r["conv_id"]: r for r in got.withColumns({"turns": m.read_turns(F.col("formatted"), template), "learned": m.learned_text(F.col("segments"))}).collect()}
    want = brute(rows, template)
    assert set(got) == set(want)
    for c, (turns, verdict, bad) in want.items():
        r = got[c]
        assert [tuple(t) for t in r["turns"]] == turns
        assert (r["verdict"], r["bad_turn"]) == (verdict, bad)
        assert r["learned"] == "".join(t for role, t in turns if role in template.learned)
        assert [s["loss"] for s in r["segments"]] == [x for role, _ in turns for x in (False, role in template.learned, False)]
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"] and r["formatted"].count("<|") == 2 * len(turns) + sum(role.count("\n") for role, _ in turns)
    return got


def test_texts_of_control_strings_are_read_back(spark):
    rng = random.Random(5)
    bits = ["<", "|", "\\", "\n", "<|im_start|>", "<|im_end|>\n", "<\\|", "im_end", ">", "é𝔘", "$1", "<|newline|>", "assistant\n", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "as\nsis<|tant", "\\", ""]), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for c in range(60) for t in range(rng.randint(1, 6))]
    check(spark, rows)


def test_order_of_turns(spark):
    words = {"s": "system", "u": "user", "a": "assistant", "t": "tool", "x": "judge"}
    cases = ["ua", "sua", "u", "s", "au", "uu", "uaa", "suauau", "sus", "uatau", "uata", "ut", "x", "uax", "uaua" * 300, "uaua" * 300 + "s" + "ua" * 300, "ua" * 255 + "u" + "a" + "a"]
    got = check(spark, [(i, t, words[x], f"{i} {t}") for i, c in enumerate(cases) for t, x in enumerate(c)])
    assert [got[i]["verdict"] for i in range(4)] == ["ok", "ok", "open", "open"] and got[15]["bad_turn"] == 1201


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", ""), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (None, 1, "user", "x"), (None, None, "assistant", "y"),
            (2, 5, "user", "late"), (2, -5, "assistant", "early"), (3, 1, "user", " " * 1_000_000), (3, 2, "assistant", "<" * 1_000_000), (4, 1, "user", "<\\" * 300_000 + "|")]
    check(spark, rows)


def test_empty_table(spark):
    empty = frame(spark, [])
    assert m.conversations(empty).count() == 0 and m.verdicts(m.parts(empty)).count() == 0


@pytest.mark.usefixtures("small_runs")
def test_one_conversation_with_a_third_of_all_turns(spark, monkeypatch):
    monkeypatch.setattr(m, "PART", 7)
    rows = [(0 if i % 3 == 0 else i, i, "user" if i // 3 % 2 == 0 else "assistant", f"t{i}") for i in range(300)]
    check(spark, rows)
    found = m.parts(frame(spark, rows))
    assert max(len(r["segments"]) for r in found.collect()) == 3 * 7
    assert {(r["conv_id"], r["verdict"], r["bad_turn"]) for r in m.verdicts(found).collect()} == {(c, v, b) for c, (_, v, b) in brute(rows).items()}


def test_another_template(spark):
    plain = m.Template("<|turn|>", "\n", "<|end|>", ("bot", "tool"), {"start": {"human": "human"}, "human": {"bot": "bot", "tool": "human"}, "bot": {"human": "human"}}, "start", ("bot", "human"))
    check(spark, [(1, 0, "human", "a<|turn|>"), (1, 1, "tool", "<|end|>"), (1, 2, "bot", "c"), (2, 0, "bot", "x")], plain)
    with pytest.raises(ValueError):
        m.Template("<|turn|>", "\n", "<|end|>", (), {"a": {"r": "b"}}, "a", ())
    with pytest.raises(ValueError):
        m.Template("[INST]", "\n", "<|end|>", (), {"a": {}}, "a", ())


def test_plan_is_one_exchange_without_python(spark):
    text = plan(queries.QUERIES["op11_chat_format"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange hashpartitioning") == 1
