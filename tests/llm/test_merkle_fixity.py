from conftest import rows

from terrasse.llm import merkle_fixity as m

SCHEMA = "file long, record long, offset long, length long, payload binary"


def records(n=300, files=3):
    out = []
    for f in range(files):
        at = 0
        for i in range(n):
            body = bytes([f, i % 256]) * (1 + (i * 37) % 400)
            out.append((f, f * n + i, at, len(body), bytearray(body)))
            at += len(body)
    return out


def test_faults_are_located(spark):
    good = records()
    bad = [list(r) for r in good]
    bad[5][4] = bytearray(b"x") + bad[5][4][1:]
    bad[299][4] = bytearray(b"y") * len(bad[299][4])
    lost = bad.pop(450)
    bad.append([1, 9999, 10**9, 3, bytearray(b"new")])
    bad.append([7, 1, 0, 3, bytearray(b"own")])
    a, b = (spark.createDataFrame([tuple(r) for r in x], SCHEMA) for x in (good, bad))
    got = rows(m.audit(a, b).select("file", "offset", "record", "fault"))
    want = [(0, good[5][2], 5, "changed"), (0, good[299][2], 299, "changed"), (1, lost[2], lost[1], "missing"), (1, 10**9, 9999, "surplus"), (7, 0, 1, "surplus")]
    assert got == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert m.audit(a, a).count() == 0


def test_only_mismatching_branches_are_entered(spark):
    a = spark.createDataFrame(records(), SCHEMA)
    tree = m.tree(m.leaves(a), 2)
    other = [level.withColumn("hash", level["hash"]) for level in tree]
    top = m._differing(tree[2], other[2], None)
    assert top.count() == 0 and m._differing(tree[1], other[1], top).count() == 0
    sizes = [level.count() for level in tree]
    assert sizes[0] > sizes[1] >= sizes[2] >= 3


def test_nulls_repeats_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (1, None, None, 5), (2, "u", "<p>é</p>", 6), (None, "v", "", 7)], "page_id long, url string, html string, payload long")
    found = m.page_records(pages)
    assert rows(found.groupBy("file").count()) == [(-1, 1), (0, 3)]
    first = found.where("record = 2").first()
    assert bytes(first["payload"]).endswith("\r\n\r\n<p>é</p>\r\n\r\n".encode()) and first["length"] == len(first["payload"])
    assert m.audit(found, found).count() == 0
    empty = found.limit(0)
    assert m.audit(empty, empty).count() == 0
    assert m.audit(found, empty).count() == 4 and {r["fault"] for r in m.audit(empty, found).collect()} == {"surplus"}
