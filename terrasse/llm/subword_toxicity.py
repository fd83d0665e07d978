"""Toxicity by averaged subword embeddings under a linear softmax, trained jointly in numpy.

Every word counts as itself and as its character n-grams, all hashed into one table of vectors.
A word's vector is the mean of its parts, a text's the mean of its words, and a linear softmax
over two classes reads the text's vector.  Table and softmax are trained together, so a misspelled
or inflected word that was never seen shares most of its vectors with the words it resembles.

Most parts say nothing about toxicity, and a rare one seems to say much by chance.  So each part is put on the scale
of its own spread over the training documents, and a penalty on the length of its vector lets it have one only if
it moves the labels by more than ``Z`` standard errors: a rare part needs documents that agree, a frequent one many, and no part
is too rare to be looked at.

Training takes at most ``SAMPLE`` labelled documents (the documented bound of the fit), one text for each id, reduced to
parts and weights on the executors.  Parts that by themselves move the labels by less than ``Z / 2`` standard errors are left
out there: what the others explain could bring them over the penalty only if it were as much again.  Scoring needs one
number per part, because the model is linear in the average; it covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasse.llm.words import mix, rolling, runs_of, slices, split_words, windows
from terrasse.settings import durable

SIZES, BUCKETS, WIDTH = (3, 4, 5, 6), 1 << 18, 8
SAMPLE, ROUNDS, Z, SEED = 8_000, 80, 3.0, 7
HOLDERS = 3  # documents that must hold a part; of two nothing can be told
PAD = 20  # neutral words in every average, so that the few words of a short text do not weigh too much
TUNED_ON = 5  # every fifth training document, by a hash, sets the point where the score passes 0.5 and nothing else
SLICE_BYTES = 1 << 20  # the parts of the words of a slice take some hundred bytes for each byte of text


def word_parts(vocab: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (itself, then its n-grams with ends marked) and where each word starts."""
    marked = ["<" + w.decode("utf-8", "replace").lower() + ">" for w in vocab]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))))
    h = mix(points + np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h + runs_of(np.diff(starts)).astype(np.uint64)), dtype=np.uint64)))
    owner, found = [np.arange(len(vocab))], [mix(total[starts[1:]] - total[starts[:-1]])]
    word = np.repeat(np.arange(len(vocab)), np.diff(starts))
    for size in SIZES:
        at = windows(starts, size)
        owner.append(word[at])
        found.append(mix(rolling(h, at, size) + np.uint64(size)))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(vocab))
    return (found[order] % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(([0], np.cumsum(counts)))


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text the distinct buckets and their weights in the text's average."""
    words = split_words(texts)
    parts, first = word_parts(words.vocab)
    per = np.diff(first)
    for a, b in zip(words.starts[:-1], words.starts[1:], strict=True):
        ids, n = np.unique(words.ids[a:b], return_counts=True)
        count = per[ids]
        bucket = parts[np.repeat(first[ids], count) + runs_of(count)]
        weight = np.repeat(n / np.maximum(count, 1), count) / (b - a + PAD)
        kept, place = np.unique(bucket, return_inverse=True)
        yield kept, np.bincount(place, weight, minlength=len(kept))


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x WIDTH
    softmax: np.ndarray  # WIDTH x 2
    bias: np.ndarray

    def part_scores(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log odds of class 1, and the constant."""
        return self.table @ (self.softmax[:, 1] - self.softmax[:, 0]), float(self.bias[1] - self.bias[0])


Bag = list[tuple[np.ndarray, np.ndarray]]


@dataclass
class Texts:
    """Training texts as one list of parts: part ``part[i]`` of text ``text[i]`` weighs ``weight[i]``."""

    text: np.ndarray
    part: np.ndarray
    weight: np.ndarray
    n: int
    parts: int

    def means(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(self.text, self.weight * vectors[self.part, k], minlength=self.n) for k in range(vectors.shape[1])], axis=1)

    def pull(self, error: np.ndarray) -> np.ndarray:
        """Sum over the texts of their errors, for each part by its weight."""
        return np.bincount(self.part, self.weight * error[self.text], minlength=self.parts)

    def spread(self) -> float:
        """The largest eigenvalue of the weights' square, by powers."""
        v = np.random.default_rng(SEED).normal(size=self.parts)
        size = 0.0
        for _ in range(10):
            v = self.pull(self.means(v[:, None])[:, 0])
            size = float(np.linalg.norm(v))
            v /= size or 1.0
        return size


def gradients(texts: Texts, label: np.ndarray, vectors: np.ndarray, softmax: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the summed cross-entropy, for vectors, softmax and bias."""
    mean = texts.means(vectors)
    logit = mean @ softmax + bias
    prob = np.exp(logit - logit.max(axis=1, keepdims=True))
    prob /= prob.sum(axis=1, keepdims=True)
    prob[np.arange(texts.n), label] -= 1
    # Two classes: the errors are opposite, so one pull serves all dimensions.
    return np.outer(texts.pull(prob[:, 1]), softmax[:, 1] - softmax[:, 0]), mean.T @ prob, prob.sum(axis=0)


def train(bag: Bag, label: np.ndarray, rounds: int = ROUNDS, z: float = Z) -> Model:
    """Vectors, softmax and bias together, by proximal gradient steps over all rows; vectors with momentum.

    Each part's weights are divided by their root sum of squares, so the penalty is the same number of standard errors for all.
    It is taken times the softmax's length, so that a longer softmax cannot evade it.  The same rows give the same model.
    """
    random = np.random.default_rng(SEED)
    table = np.zeros((BUCKETS, WIDTH), np.float32)
    softmax, share = random.uniform(-1, 1, (WIDTH, 2)), float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    bias = np.array([0.0, np.log(share / (1 - share))])
    sizes = np.array([len(b) for b, _ in bag])
    if not sizes.sum():
        return Model(table, softmax.astype(np.float32), bias.astype(np.float32))
    used, part = np.unique(np.concatenate([b for b, _ in bag]), return_inverse=True)
    weight = np.concatenate([w for _, w in bag]).astype(np.float64)
    scale = 1 / np.sqrt(np.bincount(part, weight**2))
    texts = Texts(np.repeat(np.arange(len(bag)), sizes), part, weight * scale[part], len(bag), len(used))
    least, steepest = z * np.sqrt(share * (1 - share)), texts.spread() / 4
    vectors = ahead = np.zeros((len(used), WIDTH))
    pace = 1.0
    for _ in range(rounds):
        long = np.linalg.norm(softmax[:, 1] - softmax[:, 0])
        step = 1 / (steepest * long**2)
        down, turn, shift = gradients(texts, label, ahead, softmax, bias)
        moved = ahead - step * down
        length = np.sqrt((moved**2).sum(axis=1, keepdims=True))
        moved *= np.maximum(0, 1 - step * least * long / np.maximum(length, 1e-30))
        softmax -= turn / (texts.n / 4 + (texts.means(ahead) ** 2).sum())
        bias -= 2 * shift / texts.n
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, vectors, pace = moved + (pace - 1) / faster * (moved - vectors), moved, faster
    table[used] = vectors * scale[:, None]
    return Model(table, softmax.astype(np.float32), bias.astype(np.float32))


def log_odds(model: Model, bag: Bag) -> np.ndarray:
    parts, bias = model.part_scores()
    return np.array([parts[b] @ w for b, w in bag]) + bias


def balance(odds: np.ndarray, label: np.ndarray) -> float:
    """The log odds from which on calling a document 1 gives the best F1; 0 if only one class is there."""
    if label.min(initial=1) == label.max(initial=0):
        return 0.0
    order = np.argsort(-odds, kind="stable")
    hits = np.cumsum(label[order])
    score = 2 * hits / (np.arange(1, len(order) + 1) + label.sum())
    best = int(np.argmax(score))
    after = odds[order[best + 1]] if best + 1 < len(order) else odds[order[best]] - 1
    return float((odds[order[best]] + after) / 2)


def fit(bag: Bag, label: np.ndarray, tune: np.ndarray) -> Model:
    """Train on the rows that ``tune`` does not mark and move the bias so that those it marks are judged best at 0.5; no rows give a model that scores 0.5."""
    if not bag:
        return Model(np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32))
    mine, rest = (np.flatnonzero(~tune), np.flatnonzero(tune)) if 0 < tune.sum() < len(bag) else (np.arange(len(bag)),) * 2
    model = train([bag[i] for i in mine], label[mine])
    model.bias[1] -= balance(log_odds(model, [bag[i] for i in rest]), label[rest])
    return model


def _sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, size: int) -> DataFrame:
    """At most ``size`` labelled documents, those with the smallest hash of their id; of rows of one id the smallest text."""
    order = F.xxhash64(F.col("doc_id"))
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known = F.broadcast(known.orderBy(order, "doc_id").limit(size))  # at most ``size`` rows of two numbers
    picked = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = picked.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return rows.select("doc_id", "text", "label", order.alias("place"), (F.pmod(order, F.lit(TUNED_ON)) == 0).alias("tune"))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", size: int = SAMPLE) -> Model:
    """A model from labelled rows.  Parts that tell nothing are left out before anything meets the driver."""
    spark = docs.sparkSession
    rows = durable(_sample(docs, labels, label, key, text, size), "toxicity-sample")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part the number of documents, and the sums of its weights, of their squares, and of those of class 1."""
        sums = np.zeros((4, BUCKETS))
        for part in slices(batches, limit=SLICE_BYTES):
            for (bucket, weight), y in zip(bags(part.column("text")), part.column("label").to_pylist(), strict=True):
                sums[:, bucket] += np.stack((np.ones(len(weight)), weight, weight**2, weight * y))
        held = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(held), *map(pa.array, sums[:, held])], names=["bucket", "n", "w", "w2", "wy"])

    learned = rows.where("NOT tune")
    sums = learned.select("text", "label").mapInArrow(told, "bucket bigint, n double, w double, w2 double, wy double")
    sums = sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "w", "w2", "wy")])
    share = learned.agg(F.avg("label").alias("share")).scalar()
    moved = F.abs(F.col("wy") - F.col("share") * F.col("w")) / F.sqrt(F.col("w2") * F.col("share") * (1 - F.col("share")))
    telling = sums.withColumn("share", share).where((F.col("n") >= HOLDERS) & (F.col("share") > 0) & (F.col("share") < 1)).where(moved > Z / 2)
    wanted = np.zeros(BUCKETS, bool)
    wanted[telling.select("bucket").toPandas()["bucket"].to_numpy(dtype=np.int64)] = True  # at most one number for each bucket
    wanted = spark.sparkContext.broadcast(wanted)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE_BYTES):
            kept = [(b[wanted.value[b]], w[wanted.value[b]]) for b, w in bags(part.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), part.column("doc_id"), part.column("label"), part.column("tune"), pa.array([b.astype("<i4").tobytes() for b, _ in kept], pa.binary()),
                 pa.array([w.astype("<f4").tobytes() for _, w in kept], pa.binary())],
                names=["place", "doc_id", "label", "tune", "buckets", "weights"])

    small = rows.mapInArrow(reduce, "place bigint, doc_id bigint, label int, tune boolean, buckets binary, weights binary")
    found = sorted((tuple(r) for r in small.toLocalIterator()), key=lambda r: r[:2])  # at most ``size`` rows, one for each id
    bag = [(np.frombuffer(r[4], "<i4"), np.frombuffer(r[5], "<f4")) for r in found]
    return fit(bag, np.array([r[2] for r in found], np.int64), np.array([r[3] for r in found], bool))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row; score is the softmax of class 1, for null and empty texts too.

    Rows are scored one by one; nothing but the text counts.
    """
    known = docs.sparkSession.sparkContext.broadcast(model.part_scores())  # one number per bucket
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = known.value
        for part in slices(batches, limit=SLICE_BYTES):
            words = split_words(part.column("text"))
            parts, first = word_parts(words.vocab)
            value, count = table[parts], np.diff(first)
            word = np.add.reduceat(value, first[:-1]) / count if len(value) else value
            odds = np.bincount(words.row, word[words.ids], minlength=part.num_rows) / (words.counts + PAD) + bias
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], names=["doc_id", "score"])

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double")
