import random

import numpy as np
import pyarrow as pa
from edge_cases import edge, nothing  # noqa: F401

from terrasse.llm import subword_toxicity as s

BAD = ["idiotic", "worthless", "pathetic"]


def corpus(n=600, seed=1, bad=BAD):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(["table", "river", "green", "letter", "window", "morning", "paper", "stone"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(10, 80))]
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_documents_and_unseen_spellings(spark):
    rows = corpus()
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = s.learn(docs, labels)
    fresh = corpus(200, 2, ["idiotics", "worthlesss", "patheticly"])
    got = {r["doc_id"]: r["score"] for r in s.score(spark.createDataFrame([r[:2] for r in fresh], "doc_id long, text string"), model).collect()}
    right = sum((got[i] >= 0.5) == bool(y) for i, _, y in fresh)
    assert right >= 0.95 * len(fresh)
    again = s.learn(docs.repartition(7), labels.repartition(5))
    assert np.array_equal(model.table, again.table) and model.bias.tolist() == again.bias.tolist()


def test_scores_of_the_table_are_those_of_the_model(edge):
    rng = np.random.default_rng(3)
    model = s.Model(rng.normal(size=(s.BUCKETS, s.WIDTH)).astype(np.float32), rng.normal(size=(s.WIDTH, 2)).astype(np.float32), np.array([0.1, -0.2], np.float32))
    got = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in s.score(edge, model).collect())
    table = edge.collect()
    odds = s.log_odds(model, list(s.bags(pa.array([r["text"] for r in table], pa.string()))))
    want = sorted((str(r["doc_id"]), round(float(1 / (1 + np.exp(-np.clip(o, -500, 500)))), 5)) for r, o in zip(table, odds, strict=True))
    assert got == want


def test_no_labels_one_class_and_empty_tables(spark, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in s.score(edge, s.learn(edge, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 0) for i in range(1, 15)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = s.learn(edge, one)
    assert all(0 <= r["score"] <= 1 for r in s.score(edge, model).collect())
    assert s.score(nothing, model).count() == 0


def test_shared_ngrams_and_balance():
    parts, first = s.word_parts([b"worthless", b"worthlesss", b"river"])
    a, b, c = (set(parts[x:y].tolist()) for x, y in zip(first[:-1], first[1:], strict=True))
    assert len(a & b) > 0.6 * len(a) and len(a & c) < 3
    assert s.balance(np.array([3.0, 2.0, -1.0, -2.0]), np.array([1, 1, 0, 0])) == 0.5
    assert s.balance(np.array([1.0]), np.array([1])) == 0.0


def small_bag(n=120, seed=4):
    rng = np.random.default_rng(seed)
    bag, label = [], (rng.random(n) < 0.3).astype(np.int64)
    for y in label:
        bucket = np.unique(np.concatenate((rng.integers(0, 40, 12), rng.integers(40, 44, 3) if y else rng.integers(40, 60, 1))))
        bag.append((bucket, rng.random(len(bucket)) / 20))
    return bag, label


def flat(bag):
    used, part = np.unique(np.concatenate([b for b, _ in bag]), return_inverse=True)
    weight = np.concatenate([w for _, w in bag])
    scale = 1 / np.sqrt(np.bincount(part, weight**2))
    return s.Texts(np.repeat(np.arange(len(bag)), [len(b) for b, _ in bag]), part, weight * scale[part], len(bag), len(used)), used, scale


def plain_loss(bag, label, used, scale, vectors, softmax, bias):
    """Cross-entropy text by text and part by part, without any of the module's sums."""
    place, total = {u: i for i, u in enumerate(used)}, 0.0
    for (bucket, weight), y in zip(bag, label, strict=True):
        mean = sum(w * scale[place[b]] * vectors[place[b]] for b, w in zip(bucket, weight, strict=True))
        logit = mean @ softmax + bias
        total += np.log(np.exp(logit - logit.max()).sum()) - (logit - logit.max())[y]
    return total


def test_gradients_are_those_of_the_plain_loss():
    bag, label = small_bag()
    texts, used, scale = flat(bag)
    rng = np.random.default_rng(1)
    point = [rng.normal(size=(len(used), s.WIDTH)), rng.normal(size=(s.WIDTH, 2)), rng.normal(size=2)]
    found = s.gradients(texts, label, *point)
    for k in range(3):
        for at in [tuple(rng.integers(0, d) for d in point[k].shape) for _ in range(8)]:
            values = []
            for side in (1e-5, -1e-5):
                moved = [p.copy() for p in point]
                moved[k][at] += side
                values.append(plain_loss(bag, label, used, scale, *moved))
            assert abs((values[0] - values[1]) / 2e-5 - found[k][at]) < 1e-5


def test_training_ends_at_the_optimum():
    """A part without a vector pulls less than the penalty, one with a vector exactly as much."""
    bag, label = small_bag()
    z = 2.0
    model = s.train(bag, label, rounds=3000, z=z)
    texts, used, scale = flat(bag)
    direction = model.softmax[:, 1] - model.softmax[:, 0]
    odds = texts.means((model.table[used] / scale[:, None] @ direction)[:, None])[:, 0] + model.bias[1] - model.bias[0]
    pull = texts.pull(1 / (1 + np.exp(-odds)) - label) / np.sqrt(label.mean() * (1 - label.mean()))
    active = np.abs(model.table[used]).sum(axis=1) > 0
    assert 2 <= active.sum() < 30 and set(used[active]) & {40, 41, 42, 43}
    assert np.all(np.abs(pull[~active]) < z * 1.01) and np.allclose(np.abs(pull[active]), z, rtol=0.02)


def test_held_out_fold_of_the_tables(spark):
    """Of the documents that no label was learned from, with all toxic labels and with a quarter of them."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.1"
    labels, docs = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text", "lang").repartition(4).cache()
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = labels.where(fold != 0)
    for part, least in ((1, 0.85), (4, 0.5)):
        thin = known.where((F.col("toxic") == 0) | (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(part)) == 0))
        scored = s.score(docs.select("doc_id", "text"), s.learn(docs, thin))
        held = scored.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where(fold == 0)
        hit = F.col("score") >= 0.5
        rows = held.groupBy("lang").agg(F.count_if(hit & (F.col("toxic") == 1)).alias("hits"), F.count_if(hit).alias("said"), F.sum("toxic").alias("there")).collect()
        hits, said, there = (sum(r[c] for r in rows) for c in ("hits", "said", "there"))
        assert hits >= least * there and hits >= 0.8 * said, [r.asDict() for r in rows]
        assert part > 1 or all(r["hits"] > 0.5 * r["there"] for r in rows), [r.asDict() for r in rows]


def test_repeated_ids_are_one_document(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(0, rows[0][1])] * 500 + [(1, "zzz " * 9)] * 3, "doc_id long, text string")
    once = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert np.array_equal(s.learn(docs, labels).table, s.learn(once, labels).table)


def test_very_long_and_repeated_texts(spark):
    model = s.learn(spark.createDataFrame([r[:2] for r in corpus(300)], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in corpus(300)], "doc_id long, toxic int"))
    docs = spark.createDataFrame([(1, "a" * 1_000_000), (2, "idiotic " * 150_000), (3, " " * 1_000_000), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in s.score(docs, model).collect()}
    assert all(0 <= x <= 1 for x in got.values()) and got[2] > 0.5 > got[3] == got[4]
