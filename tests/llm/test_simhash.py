import re

import numpy as np
import pytest
import xxhash
from edge_cases import edge, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from terrasse.llm import components, simhash


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, prints, radius):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in zip(ids, prints, strict=True):
        for j, b in zip(ids, prints, strict=True):
            if i < j and (a ^ b).bit_count() <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_match_the_definition(edge):
    got = {(r["doc_id"], r["fp"] & (1 << 64) - 1) for r in simhash.fingerprint_documents(edge).collect()}
    assert got == {(r["doc_id"], fingerprint(r["text"])) for r in edge.collect()}


def test_edge_documents(edge, nothing):
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == edge.count() and simhash.near_duplicates(nothing).count() == 0
    want = [(r["doc_id"], fingerprint(r["text"])) for r in edge.collect()]
    known = dict(x for x in want if x[0] is not None)
    root = classes(list(known), list(known.values()), 2)
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == sorted(
        (str(i), f"{f:016x}", str(root.get(i))) for i, f in want)
    kept = simhash.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, *(i for i in root if root[i] == i)}


@pytest.mark.parametrize("tile", [4096, 7])
def test_components_of_planted_fingerprints(spark, monkeypatch, tile):
    """Dense clusters, chains and far pairs, also with cells cut into many tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(5)
    prints = set()
    for _ in range(12):
        base = int(rng.integers(0, 1 << 63))
        prints |= {base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (12, 2))}
        chain = base ^ 0xFFFF
        for step in range(20, 40, 2):
            chain ^= 3 << step
            prints.add(chain)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame(list(zip(signed, range(len(signed)), strict=True)), "fp long, id long")
    found = {r["node"]: r["root"] for r in components.connected(simhash.links(frame)).collect()}
    want = classes(list(range(len(prints))), prints, 2)
    assert {i: found.get(i, i) for i in want} == want


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
@settings(max_examples=50, deadline=None)
def test_forest_reaches_what_the_links_reach(pairs):
    u, v = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    label = simhash.forest(u, v, 31)
    want = list(range(31))
    for _ in range(31):
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    assert label.tolist() == want


def test_tile_links_of_a_dense_tile_form_a_tree():
    base = np.uint64(12345)
    a = base ^ (np.uint64(1) << np.arange(60, dtype=np.uint64))
    node, label = simhash.tile_links(a, a, 2)
    assert len(node) < 2 * len(a) and set(label.tolist()) == {0}


def test_components_refuse_to_stop_early(spark):
    chain = spark.range(200).selectExpr("id as u", "id + 1 as v")
    assert {r["root"] for r in components.connected(chain).collect()} == {0}
    with pytest.raises(RuntimeError):
        components.connected(chain, rounds=1)
