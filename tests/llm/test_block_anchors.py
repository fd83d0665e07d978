import hashlib
import random
import re

import pytest
from edge_cases import edge, nothing  # noqa: F401

from terrasse.llm import block_anchors, bloom


def brute(docs, length):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for i, t in docs:
        w = split(t)
        for p in range(len(w) - length + 1):
            seq = tuple(w[p : p + length])
            if i is not None:
                first[seq] = min(first.get(seq, i), i)
    out = []
    for i, t in docs:
        w = split(t)
        gone = set()
        for p in range(len(w) - length + 1):
            if i is not None and first[tuple(w[p : p + length])] < i:
                gone |= set(range(p, p + length))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(frame):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())


def corpus(n=120, seed=1):
    """Shared passages at all offsets, near copies, whole copies, and repeats within one document."""
    rng = random.Random(seed)
    word = lambda k: [f"w{rng.randint(0, 10**6)}" for _ in range(k)]
    passages = [word(rng.randint(40, 160)) for _ in range(6)]
    docs, last = [], word(200)
    for i in range(n):
        kind = rng.random()
        if kind < 0.2:
            body = last
        elif kind < 0.4:
            body = [*last]
            body[rng.randrange(len(body))] = "changed"
        elif kind < 0.7:
            body = word(rng.randint(0, 60)) + rng.choice(passages) + word(rng.randint(0, 60)) + rng.choice(passages)
        elif kind < 0.8:
            part = word(55)
            body = part + word(10) + part
        else:
            body = last = word(rng.randint(0, 300))
        docs.append((i, " ".join(body)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("copies", [1 << 18, 1])
def test_matches_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(block_anchors, "COPY_GROUPS", copies)
    docs = corpus()
    assert result(block_anchors.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs, 50)


def test_a_crowded_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(bloom, "words_for", lambda keys: 1 << 6)
    docs = corpus(40, 2)
    assert result(block_anchors.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs, 50)


def test_texts_of_the_stage_are_packed(spark, monkeypatch):
    """The words that wait for the last join are the largest part of the stage, so it is written with the denser codec."""
    kept, durable = {}, block_anchors.durable
    monkeypatch.setattr(block_anchors, "durable", lambda df, label, *a: kept.setdefault(label, durable(df, label, *a)))
    words = [random.Random(3).choice(["the", "house", "stands", "near", "old", "river", "and", "town"]) + str(i % 3) for i in range(4000)]
    docs = [(i, " ".join([f"own{i}", *words[i : i + 2000]])) for i in range(8)]
    assert result(block_anchors.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs, 50)
    files = kept["extended"].inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_edge_documents_and_kept_texts(edge, nothing):
    got = block_anchors.remove_repeats(edge)
    assert result(got) == brute([(r["doc_id"], r["text"]) for r in edge.collect()], 50)
    for r in got.where("doc_id in (7, 8)").collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
    assert got.where("n_removed = 0 and kept_text is not null").count() == 0
    assert block_anchors.remove_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        block_anchors.remove_repeats(nothing, length=48)
