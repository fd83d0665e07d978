import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import EDGE, edge, nothing, prose, rows_to_docs  # noqa: F401

from terrasse.llm import queries
from terrasse.llm import token_alignment as m


@pytest.fixture(scope="module")
def pair():
    return m.TokenizerPair.load()


def byte_owners(ids, vocabulary):
    """The token that each byte belongs to."""
    return [i for i, t in enumerate(ids) for _ in vocabulary[t].as_py()]


def brute(texts, pair):
    """Byte by byte: owners of each byte on both sides give links; places where both change owner give groups."""
    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        spelt = [b"".join(v[i].as_py() for i in ids) for ids, v in ((a, pair.a_bytes), (b, pair.b_bytes))]
        if spelt != [(" " + text).encode()] * 2:
            docs.append(None)
            continue
        owners = list(zip(byte_owners(a, pair.a_bytes), byte_owners(b, pair.b_bytes), strict=True))
        links = sorted(set(owners))
        groups, last = [([], [])], None
        for x, y in owners:
            if last and x != last[0] and y != last[1]:
                groups.append(([], []))
            if not last or x != last[0]:
                groups[-1][0].append(a[x])
            if not last or y != last[1]:
                groups[-1][1].append(b[y])
            last = x, y
        docs.append((a, b, groups, [(a[x], b[y]) for x, y in links]))
    held = Counter(p for d in docs if d for p in set(d[3]))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), text))
    return out


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
HARD = ["▁", "a▁b", "<|endoftext|> <s></s> <unk> <0x41>", "naïve ﬁ 𝔘 é é", "日本語のテキスト 한국어", "\x00\x01\x7f", "  two  spaces  ", "a\r\n\tb", "🙂🙂👨‍👩‍👧", "  　x", "'s 're don't", "x" * 3000, " " * 3000]


def test_against_bytes(spark, pair, monkeypatch):
    monkeypatch.setattr(m, "SLICE_BYTES", 4000)
    texts = [None, "", *HARD, *[prose(i % 9, 40 + i) for i in range(40)], *[prose(3, 30)] * 5]
    frame = rows_to_docs(spark, list(enumerate(texts))).repartition(3)
    got = {r["doc_id"]: (*[r[f] for f in FIGURES], r["groups"]) for r in m.alignments(frame, pair).collect()}
    want = brute(texts, pair)
    assert [got[i] for i in range(len(texts))] == want
    assert {i for i, w in enumerate(want) if not w[0]} >= {0, 1, 2, 3}
    digests = {r["doc_id"]: r["groups_sha256"] for r in m.alignments(frame, pair, groups="digest").collect()}
    assert digests == {i: hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for i, w in enumerate(want)}


def test_table_of_the_driver(spark, pair):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = brute([r["text"] for r in docs], pair)
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    for r, w in zip(docs, want, strict=True):
        g = got[r["doc_id"]]
        assert (*[g[f] for f in FIGURES], g["groups_sha256"]) == (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "")


def test_edge_rows(spark, pair, edge):  # noqa: F811
    want = brute([t for _, t in EDGE], pair)
    got = m.alignments(edge, pair).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(((r["doc_id"], *[r[f] for f in FIGURES], r["groups"]) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(EDGE, want, strict=True)), key=key)


def test_a_megabyte_of_one_character_or_word(spark, pair):
    texts = ["a" * 1_000_000, " " * 1_000_000, "\n" * 300_000, "word " * 200_000, "é" * 200_000]
    rows = {r["doc_id"]: r for r in m.alignments(rows_to_docs(spark, list(enumerate(texts))), pair).collect()}
    assert all(rows[i]["n_links"] == rows[i]["n_a"] + rows[i]["n_b"] - rows[i]["n_groups"] > 0 for i in range(len(texts)))


def test_no_documents_and_only_unusable_ones(spark, pair, nothing):  # noqa: F811
    assert m.alignments(nothing, pair).count() == 0
    rows = m.alignments(rows_to_docs(spark, [(1, None), (1, ""), (None, "▁")]), pair).collect()
    assert [tuple(r) for r in sorted(rows, key=lambda r: str(r["doc_id"]))] == [(1, 0, 0, 0, 0, "", 0, 0)] * 2 + [(None, 0, 0, 0, 0, "", 0, 0)]


def test_alphabet_and_vocabularies(pair):
    assert sorted(m.byte_alphabet().values()) == list(range(256))
    assert pair.a_bytes[220].as_py() == b" " and len(pair.a_bytes) == 50257 and len(pair.b_bytes) == 32000
    ids = pa.array([[220, 64], [], [65]], pa.list_(pa.int32()))
    assert m.joined_bytes(ids, pair.a_bytes).to_pylist() == [b" " + pair.a_bytes[64].as_py(), b"", pair.a_bytes[65].as_py()]
    assert np.array_equal(m._ends(ids, pair.a_bytes)[0].to_numpy(), [1, 2, (2 << 32) + 1])


def test_both_ways_of_encoding_agree(pair, monkeypatch):
    """Every code point, between letters, digits and spaces."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 4000):
        text = " ".join(f"a{c}b {c}1 {c}{c}  {c}" for c in chars[at : at + 4000])[:100_000]
        assert np.array_equal(pair.encode_a(text), pair.a.encode(" " + text, add_special_tokens=False).ids)
    assert pair.a_ranks is not None and m.TokenizerPair(pair.files[0].replace(b'"use_regex": true', b'"use_regex": false').replace(b'"use_regex":true', b'"use_regex":false'), pair.files[1]).a_ranks is None
