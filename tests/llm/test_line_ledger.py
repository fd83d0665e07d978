import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from edge_cases import edge, nothing  # noqa: F401

from terrasse.llm import line_ledger as ll
from terrasse.settings import fresh_path

LONG = [f"Line number {i} is long enough to count as a line of its own" for i in range(12)]


def brute(docs, min_docs=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in docs:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 40:
                    holders[key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(holders.get(key(x), ())) < min_docs or i == max(holders[key(x)])]
        out.append((str(i), len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


def result(frame):
    return sorted((str(r["doc_id"]), r["__n_lines"], r["__n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in frame.collect())


def corpus(n=40, seed=3):
    rng = random.Random(seed)
    return [(i, "\n".join(rng.choice(["", "short", "  " + rng.choice(LONG).upper() + "\t", rng.choice(LONG), "é" * 39, "é" * 40]) for _ in range(rng.randint(0, 8)))) for i in range(n)]


def ledger(spark, **how):
    return ll.LineLedger(spark, fresh_path(spark, "lines-test"), shards=3, **how)


def test_bulk_matches_brute_force(spark, edge):
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()] + [(100 + i, t) for i, t in corpus()] + [(100, corpus()[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    book = ledger(spark)
    book.insert(frame)
    assert result(book.clean(frame)) == brute(docs)


@pytest.mark.parametrize("size", [1 << 26, 0])
def test_insert_and_delete_are_reversible(spark, monkeypatch, size):
    """Batches in and out give what one batch of the rest gives; without filters too."""
    monkeypatch.setattr(ll, "FILTER_BYTES", size)
    docs = corpus()
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    book = ledger(spark)
    book.insert(frame(docs[:15]))
    book.insert(frame(docs[15:]))
    assert result(book.clean(frame(docs))) == brute(docs)
    book.delete(spark.createDataFrame([(i,) for i in range(5, 35)] + [(999,), (None,)], "doc_id long"))
    rest = docs[:5] + docs[35:]
    assert result(book.clean(frame(rest))) == brute(rest)
    book.insert(frame(docs[5:35]))
    assert result(book.clean(frame(docs))) == brute(docs)
    assert {r["n_docs"] for r in book.counts().collect()} == {r["n_docs"] for r in _once(spark, docs).counts().collect()}
    with pytest.raises(ValueError):
        book.insert(frame(docs[:1]))


def _once(spark, docs):
    book = ledger(spark)
    book.insert(spark.createDataFrame(docs, "doc_id long, text string"))
    return book


def test_empty_table_and_own_columns(spark, nothing, edge):
    book = ledger(spark)
    book.insert(nothing)
    assert book.clean(nothing).count() == 0
    out = book.clean(edge)
    assert out.columns == [*edge.columns, "__n_lines", "__n_dropped"]
    assert result(out) == brute([(r["doc_id"], r["text"]) for r in edge.collect()], min_docs=10**9)


def test_cuckoo_filter_holds_and_gives_back():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 256, (2000, 16), dtype=np.uint8)
    made = ll.CuckooFilter.sized(len(keys))
    assert all(made.insert(k) for k in keys) and made.contains(keys).all()
    other = rng.integers(0, 256, (20_000, 16), dtype=np.uint8)
    assert made.contains(other).mean() < 0.01
    assert all(made.delete(k) for k in keys[:1000]) and made.contains(keys[1000:]).all()
    assert made.contains(keys[:1000]).mean() < 0.01
    again = ll.CuckooFilter.load(made.dump())
    assert again.contains(keys[1000:]).all()
    small = ll.CuckooFilter(16)
    assert not all(small.insert(k) for k in keys)


def test_full_filters_are_rebuilt(spark):
    docs = [(d, "\n".join(f"{i:03d} a line that every single document of this set has" for i in range(900))) for d in range(5)]
    book = ll.LineLedger(spark, fresh_path(spark, "lines-test"), shards=1)
    book.insert(spark.createDataFrame([(100 + d, t.split("\n")[0]) for d, t in docs], "doc_id long, text string"))
    book.insert(spark.createDataFrame(docs, "doc_id long, text string"))
    kept = {r["doc_id"]: r["__n_dropped"] for r in book.clean(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == {0: 900, 1: 900, 2: 900, 3: 900, 4: 1}
