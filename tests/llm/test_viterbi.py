import math
import random

import pyarrow as pa
import pytest
from edge_cases import edge, nothing  # noqa: F401

from terrasse.llm import piece_codec, separator_scan, viterbi
from terrasse.llm.viterbi import MARK, Encoder, Pieces, Stream, decode
from terrasse.settings import fresh_path


@pytest.fixture(scope="module")
def public():
    return Pieces.load(piece_codec.MODEL)


def tiny(straddle=False):
    texts = ["", "<s>", "</s>", MARK, "a", "b", "ab", "ba", "aab", MARK + "a", MARK + "ab", "é", "bbbb"] + (["a" + MARK + "b"] if straddle else [])
    texts[1] = texts[2] = ""
    first = len(texts)
    return Pieces(texts + [""] * 256, [0.0, 0.0, 0.0] + [-1.0 - 0.3 * i for i in range(first - 3)] + [0.0] * 256, list(range(first, first + 256)))


def brute(p, text):
    """Full Viterbi over all boundaries; longer last pieces win ties."""
    if not text:
        return []
    text = " " + text
    known = {t.replace(MARK, " "): i for i, t in enumerate(p.texts) if t}
    best = [(0, 0, None)]
    for e in range(1, len(text) + 1):
        options = []
        for size in range(min(p.reach, e), 0, -1):
            w = text[e - size : e]
            if MARK not in w and w in known:
                options.append((best[e - size][0] + p.scores[known[w]], size, known[w]))
            elif size == 1:
                options.append((best[e - 1][0] + p.lowest * len(w.encode()), 1, w))
        top = max(o[0] for o in options)
        best.append(next(o for o in options if o[0] == top))
    out, e = [], len(text)
    while e:
        _, size, found = best[e]
        out = ([found] if isinstance(found, int) else [p.byte_ids[b] for b in found.encode()]) + out
        e -= size
    return out


def texts(seed, alphabet, n, top):
    rng = random.Random(seed)
    return ["", None, " ", "\n", MARK, "é" * 90, "ab" * 100] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, top))) for _ in range(n)]


@pytest.mark.parametrize("straddle", [False, True])
def test_small_vocabularies_match_full_viterbi(straddle):
    p = tiny(straddle)
    assert p.cuttable != straddle
    given = texts(1, "aaabbb  é" + MARK + "z", 300, 120)
    starts, ids = Encoder(p).encode(pa.array(given, pa.string()))
    for i, t in enumerate(given):
        got = ids[starts[i] : starts[i + 1]].tolist()
        assert got == brute(p, t) and decode(p, got) == (t or "")


def test_public_vocabulary_matches_and_round_trips(public):
    given = texts(2, "the and ing  \n" + MARK + "ü漢𝔘", 150, 200)
    starts, ids = Encoder(public).encode(pa.array(given, pa.string()))
    for i, t in enumerate(given):
        got = ids[starts[i] : starts[i + 1]].tolist()
        assert got == brute(public, t) and decode(public, got) == (t or "")


def test_stream_commits_early_and_forgets(public):
    rng = random.Random(3)
    text = "".join(rng.choice("thesing") for _ in range(4000))
    stream, out, most = Stream(public), [], 0
    for a in range(0, len(text), 13):
        out += stream.feed(text[a : a + 13])
        most = max(most, len(stream.back), len(stream.best))
    early = len(out)
    out += stream.finish()
    assert out == brute(public, text) and early > 0.9 * len(out) and most < 10 * public.reach


def test_tables_round_trip(edge, nothing, public):
    rows = piece_codec.decode_documents(piece_codec.encode_documents(edge, public), public)
    assert set(rows.columns) == {*edge.columns, "decoded"}
    for r in rows.collect():
        assert r["decoded"] == (r["text"] or "")
    assert piece_codec.encode_documents(nothing, public).count() == 0


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_separator_scan_matches_lengths(spark, edge, public, block, monkeypatch):
    path = fresh_path(spark, "flat")
    separator_scan.write_tokens(edge.limit(0).unionByName(edge) if block == 64 else edge, path, piece_codec.MODEL)
    monkeypatch.setattr(separator_scan, "BLOCK_BYTES", block)
    small = edge.where("length(text) < 2000 or text is null") if block < 64 else edge
    if block < 64:
        path = fresh_path(spark, "flat")
        separator_scan.write_tokens(small, path, piece_codec.MODEL)
    got = separator_scan.scan(spark, path, public.eos, 2, block).collect()
    want = [len(r["ids"]) for r in piece_codec.encode_documents(small.select("text"), public).collect()]
    assert sorted(r["n_tokens"] for r in got) == sorted(want) and all(r["closed"] for r in got)
    for name in {r["path"] for r in got}:
        mine = sorted((r["nth"], r["start"], r["n_tokens"]) for r in got if r["path"] == name)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert all(a[1] + a[2] + 1 == b[1] for a, b in zip(mine, mine[1:], strict=False))


def test_open_ends_and_empty_documents(spark, tmp_path):
    flat = [5, 2, 2, 7, 7, 7, 2, 9, 9]
    (tmp_path / "part-00000-x-c000.txt").write_bytes(b"".join(i.to_bytes(2, "little") for i in flat))
    for block in (2, 4, 8, 100):
        got = separator_scan.scan(spark, str(tmp_path), 2, 2, block)
        rows = sorted((r["nth"], r["start"], r["n_tokens"], r["closed"]) for r in got.collect())
        assert rows == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 3, True), (3, 7, 2, False)]
    with pytest.raises(ValueError):
        separator_scan.scan(spark, str(tmp_path), 2, 2, 3)


def test_counts_carry_the_ids(spark, edge, nothing, public):
    stored = fresh_path(spark, "docs")
    edge.write.parquet(stored)
    docs = spark.read.parquet(stored)
    got = separator_scan.count_tokens(docs, fresh_path(spark, "flat"), piece_codec.MODEL)
    want = [(r["doc_id"], len(r["ids"])) for r in piece_codec.encode_documents(edge.drop("ids"), public).collect()]
    assert sorted(str((r["doc_id"], r["n_tokens"])) for r in got.collect()) == sorted(map(str, want))
    empty = fresh_path(spark, "docs")
    nothing.write.parquet(empty)
    assert separator_scan.count_tokens(spark.read.schema(nothing.schema).parquet(empty), fresh_path(spark, "flat"), piece_codec.MODEL).count() == 0


def test_bytes_are_needed():
    with pytest.raises(ValueError):
        Pieces(["a"], [0.0], [-1] * 256)
    assert abs(sum(map(math.exp, viterbi.zipf(list(range(1000))))) - 1) < 1e-9
