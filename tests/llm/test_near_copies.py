import random
import re

import corpus_pipeline as cp
import numpy as np
import pyarrow as pa
import pytest
from edge_cases import edge, nothing, prose, rows_to_docs  # noqa: F401

from terrasse.llm import near_copies


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept(docs):
    """Smallest ids of the components of all pairs of similarity 0.8 or more, by brute force."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i < j and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in root}


def copies(n, changes, seed=3):
    """Documents of 60-400 words, each with copies in which some words are replaced."""
    rng, out = random.Random(seed), []
    for k in range(n):
        words = prose(1000 + k, rng.randint(60, 400)).split()
        out.append((10 * k, " ".join(words)))
        for c, share in enumerate(changes, 1):
            new = list(words)
            for at in rng.sample(range(len(new)), max(1, int(share * len(new)))):
                new[at] = prose(rng.randrange(1 << 30), 1)
            out.append((10 * k + c, " ".join(new)))
    return out


def test_stage_keeps_what_brute_force_keeps(spark):
    docs = copies(60, [0.005, 0.01, 0.02, 0.03, 0.06])
    want = kept(docs)
    assert 60 < len(want) < 300
    assert {r["doc_id"] for r in cp.near_duplicates(spark, rows_to_docs(spark, docs).repartition(5), "").collect()} == want


@pytest.mark.parametrize("rows", [128, 3])
def test_one_large_group_in_many_chunks(spark, monkeypatch, rows):
    monkeypatch.setattr(near_copies, "CHUNK_ROWS", rows)
    monkeypatch.setattr(near_copies, "TILE", 8)
    docs = [(10 * k + i, t) for k, (_, t) in enumerate(copies(1, [0.005 + 0.0015 * c for c in range(30)])) for i in (0, 1)]
    assert {r["doc_id"] for r in cp.near_duplicates(spark, rows_to_docs(spark, docs), "").collect()} == kept(docs)


def test_edge_documents(spark, edge, nothing):
    out = cp.near_duplicates(spark, edge, "")
    want = kept([(r["doc_id"], r["text"]) for r in edge.collect() if r["doc_id"] is not None])
    assert out.columns == edge.columns and sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
        str(r["doc_id"]) for r in edge.collect() if r["doc_id"] is None or r["doc_id"] in want)
    assert cp.near_duplicates(spark, nothing, "").count() == 0


def test_similar_sets_at_the_border():
    """Four of five shared is similar, less is not."""
    sets = [np.arange(4), np.arange(5), np.arange(100, 109), np.arange(101, 110), np.arange(102, 111), np.arange(200, 207), np.arange(201, 208)]
    ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    assert near_copies.similar_sets(np.concatenate(sets).astype(np.uint64), ends).tolist() == [0, 0, 2, 2, 2, 5, 6]


def test_sets_of_words():
    texts = ["a b c d e f", "A b c d e a b c d e", "x y", "", None]
    _, ends = near_copies.shingle_sets(pa.array(texts))
    assert np.diff(ends).tolist() == [len(shingles(t)) for t in texts]
