import random
from collections import Counter

import pytest
from conftest import plan, rows

from terrasse.operators import search, search_index
from terrasse.settings import fresh_path

WORDS = "alpha beta gamma delta the of in on årsak 42 x".split()


def texts(spark, found):
    return spark.createDataFrame(list(found.items()), "id bigint, body string")


def agree(spark, df, path):
    for q in ("the", "the of", "alpha, BETA", "årsak 42", "absent", "the the"):
        assert rows(search_index.search(spark, path, q, "id", limit=None)) == rows(search.keyword_search(df, "id", "body", q, limit=None))
    assert [tuple(r) for r in search_index.search(spark, path, "the", "id", limit=3).collect()] == [tuple(r) for r in search.keyword_search(df, "id", "body", "the", limit=3).collect()]


def test_updates_equal_a_search_of_the_texts(spark):
    rng, path, state = random.Random(1), fresh_path(spark, "index"), {}
    changed = []
    for step in range(4):
        before = dict(state)
        for _ in range(15):
            state[rng.randrange(30)] = rng.choice([None, "", " ".join(rng.choices(WORDS, k=rng.randint(1, 12)))])
        for k in rng.sample(sorted(state), 3 if step else 0):
            del state[k]
        df = texts(spark, state)
        changed.append(search_index.update(df, path, "id", "body", buckets=8))
        assert changed[-1] == sum(before.get(k, 0) != state.get(k, 0) for k in before.keys() | state.keys())
        agree(spark, df, path)
        if step == 2:
            search_index.compact(spark, path)
            agree(spark, df, path)
            search_index.compact(spark, path)
    assert search_index.update(texts(spark, state), path, "id", "body") == 0
    agree(spark, texts(spark, state), path)
    got = rows(search_index.generations(spark, path), "gen", "base", "changed")
    assert [g[2] for g in sorted(got)] == [*changed[:3], 0, changed[3], 0] and [g[1] for g in sorted(got)] == [0, 0, 0, 3, 3, 3]


def test_a_search_reads_the_buckets_of_its_terms(spark):
    path = fresh_path(spark, "index")
    search_index.update(texts(spark, {i: f"word{i} common" for i in range(200)}), path, "id", "body", buckets=16)
    found = search_index.postings_of(spark, path, ["word7"])
    text = plan(found)
    assert "PartitionFilters" in text and "bucket" in text.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [IsNotNull(term), EqualTo(term,word7)]" in text
    assert found.count() == 1


def test_a_change_writes_its_own_postings_only(spark):
    path, state = fresh_path(spark, "index"), {i: f"word{i} common" for i in range(50)}
    search_index.update(texts(spark, state), path, "id", "body", buckets=8)
    state[3], state[60] = "word3 new new", "common"
    del state[9]
    assert search_index.update(texts(spark, state), path, "id", "body") == 3
    added = spark.read.parquet(f"{path}/postings").filter("gen = 1")
    assert rows(added, "doc", "term", "tf") == rows(spark.createDataFrame(
        [(3, "word3", 1), (3, "new", 2), (3, "common", 0), (60, "common", 1), (9, "word9", 0), (9, "common", 0)], "doc bigint, term string, tf int"))
    agree(spark, texts(spark, state), path)


def test_terms_are_counted_inside_their_text(spark, monkeypatch):
    """No aggregation over exploded words, whose memory in a task would grow with the texts that the task reads."""
    path, seen, write = fresh_path(spark, "index"), [], search_index._write_postings
    monkeypatch.setattr(search_index, "_write_postings", lambda postings, *a: (seen.append(plan(postings)), write(postings, *a)))
    rng, state = random.Random(2), {}
    for _ in range(2):
        state = {i: rng.choice([None, "", " ".join(rng.choices(WORDS, k=rng.randint(1, 40)))]) for i in range(20)}
        search_index.update(texts(spark, state), path, "id", "body", buckets=4)
    assert len(seen) == 2 and not any("Aggregate" in p for p in seen)
    counts = [(term, i, n) for i, t in state.items() for term, n in Counter((t or "").split()).items()]
    now = search_index.postings_of(spark, path, WORDS).filter("tf > 0")
    assert rows(now, "term", "doc", "tf") == rows(spark.createDataFrame(counts, "term string, doc bigint, tf int"))


def test_texts_are_not_sorted(spark, monkeypatch):
    """A first update moves no text; a later one hashes the digests of the changed texts, above the broadcast limit as well."""
    path, state, seen, write = fresh_path(spark, "index"), {i: f"word{i} the" for i in range(5)}, [], search_index._write_postings
    monkeypatch.setattr(search_index, "_write_postings", lambda postings, *a: (seen.append(plan(postings)), write(postings, *a)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert search_index.update(texts(spark, state), path, "id", "body", buckets=4) == 5
        assert not any(step in seen[-1] for step in ("Join", "Exchange", "Sort"))
        for most, join, word in (("500000", "BroadcastHashJoin", "of"), ("1", "ShuffledHashJoin", "in")):
            spark.conf.set("spark.terrasse.broadcastRows", most)
            state |= {3: f"the {word} the", 30: word, 31: None if word == "of" else "the"}
            state.pop(4, None)
            assert search_index.update(texts(spark, state), path, "id", "body") == (4 if word == "of" else 3)
            assert join in seen[-1].split("Union")[1].split("SortMergeJoin")[0]
    finally:
        spark.conf.unset("spark.terrasse.broadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for q in ("the", "the in"):
        assert rows(search_index.search(spark, path, q, "id", limit=None)) == rows(search.keyword_search(texts(spark, state), "id", "body", q, limit=None))


def test_null_and_repeated_keys_and_no_texts(spark):
    path = fresh_path(spark, "index")
    with pytest.raises(LookupError):
        search_index.postings_of(spark, path, ["a"])
    with pytest.raises(ValueError):
        search_index.update(spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, body string"), path, "id", "body")
    search_index.update(spark.createDataFrame([(None, "a"), (None, "a")], "id bigint, body string"), path, "id", "body")
    assert search_index.search(spark, path, "a", "id").count() == 0
    search_index.update(spark.createDataFrame([(2, "a b")], "id bigint, body string"), path, "id", "body")
    assert search_index.search(spark, path, "a", "id").count() == 1
    with pytest.raises(ValueError):
        search_index.search(spark, path, "!", "id")


def test_a_failed_update_is_not_seen(spark, monkeypatch):
    path, state = fresh_path(spark, "index"), {1: "alpha", 2: "beta"}
    search_index.update(texts(spark, state), path, "id", "body")
    close = search_index._close
    monkeypatch.setattr(search_index, "_close", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        search_index.update(texts(spark, {1: "gamma", 5: "alpha"}), path, "id", "body")
    monkeypatch.setattr(search_index, "_close", close)
    agree(spark, texts(spark, state), path)
    state[2] = "alpha beta"
    search_index.update(texts(spark, state), path, "id", "body")
    agree(spark, texts(spark, state), path)


def test_products_by_index(spark):
    path = fresh_path(spark, "index")
    products = spark.createDataFrame(
        [("hr.staff", "Staff", "all the people", "hr", "team", ["a"], ["person_id", "name"]), ("hr.pay", "Pay", "what the people earn", "hr", "team", ["b"], ["amount"])],
        "product_id string, name string, description string, domain string, owner string, tags array<string>, columns array<string>")
    text = search.product_text(products, search.PRODUCT_FIELDS, search.PRODUCT_LISTS)
    search_index.update(products.withColumn("body", text), path, "product_id", "body")
    usage = spark.createDataFrame([("hr.pay", 7)], "product_id string, views bigint")
    for q in ("people", "name", "people earn"):
        plain, fast = (rows(search.product_search(products, q, usage, index=i), "product_id", "score", "column_matches", "snippet", "views") for i in (None, path))
        assert plain == fast and plain
