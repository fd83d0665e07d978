"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps what was measured and one bit per
failed rule; a policy is a version name with a mask of the rules it enforces.  Applying another
policy, or asking what a policy would keep without one of its rules, needs only bit operations on
the ledger: `ablations` first counts documents per bit pattern, then works on those few counts.

Null texts count as empty, rows are judged one by one, so ties, repeated rows and empty tables
need no care; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.llm.words import SPACES, count_bytes, plain, slices, split_words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOLS, _UPPER = _table(b"#*$%&|<>"), _table(bytes(range(65, 91)))
_POINTS = ~_table(SPACES + bytes(range(0x80, 0xC0)))  # first bytes of code points that are no white space


@dataclass(frozen=True)
class Rule:
    """Fails where ``weight * measure > bound * per``; ``per`` may be a measure or 1, ``below`` turns it round."""

    bit: int
    name: str
    measure: str
    weight: int
    bound: int
    per: str | None = None
    below: bool = False


# A bit keeps its meaning for ever; new rules take new bits.
RULES = (
    Rule(0, "too_few_words", "n_words", 1, 50, below=True),
    Rule(1, "repeated_windows", "n_repeat_words", 100, 50, "n_words"),
    Rule(2, "symbols", "n_symbols", 10, 3, "n_words"),
    Rule(3, "shouting", "n_upper", 100, 30, "word_chars"),
    Rule(4, "repeated_lines", "n_dup_lines", 100, 50, "n_lines"),
    Rule(5, "short_words", "word_chars", 1, 2, "n_words", below=True),
    Rule(6, "long_words", "word_chars", 1, 40, "n_words"),
)
BASE_MASK = 0b11
POLICIES = {"base": BASE_MASK, "2024.1": 0b1111, "2024.2": 0b1111111}
CURRENT = "2024.2"


def measured(texts: pa.Array) -> dict[str, np.ndarray]:
    """All measurements of a column of texts."""
    texts = plain(texts)
    words = split_words(texts)
    found = {
        "n_words": words.counts, "word_chars": count_bytes(texts, _POINTS),
        "n_symbols": count_bytes(texts, _SYMBOLS), "n_upper": count_bytes(texts, _UPPER),
    }

    lists = pc.split_pattern(texts, "\n")
    lines, per_row = lists.flatten().dictionary_encode(), np.diff(lists.offsets.to_numpy())
    wordy = pc.greater(pc.binary_length(pc.ascii_trim(lines.dictionary, SPACES.decode())), 0).to_numpy(zero_copy_only=False)
    ids, row = lines.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), per_row)
    again = pd.Series(row * max(len(wordy), 1) + ids).duplicated().to_numpy() & wordy[ids]
    found |= {"n_lines": np.bincount(row[wordy[ids]], minlength=len(texts)), "n_dup_lines": np.bincount(row[again], minlength=len(texts))}

    # Three factorisations give equal windows of one text the same number, without hashing.
    ids, row = words.ids.astype(np.int64), words.row
    covered = np.zeros(len(ids), bool)
    if len(ids) > 2:
        v = len(words.vocab)
        code = pd.factorize(row[:-2] * v + ids[:-2])[0]
        for shift in (1, 2):
            code = pd.factorize(code * v + ids[shift : len(ids) - 2 + shift])[0]
        whole = row[2:] == row[:-2]
        twice = whole & (np.bincount(code[whole], minlength=code.max() + 1)[code] > 1)
        for shift in range(3):
            covered[shift : len(ids) - 2 + shift] |= twice
    found["n_repeat_words"] = np.bincount(row[covered], minlength=len(texts))
    return found


def fail_bits(found: Mapping[str, np.ndarray]) -> np.ndarray:
    """A bit for every rule that a text's measurements break: the one place where rules are compared."""
    bits = np.zeros(len(next(iter(found.values()))), np.int64)
    for r in RULES:
        left, right = r.weight * found[r.measure], r.bound * (found[r.per] if r.per else 1)
        bits |= (left < right if r.below else left > right).astype(np.int64) << r.bit
    return bits


def _judged(texts: pa.Array) -> dict[str, np.ndarray]:
    found = {m: v.astype(np.int64) for m, v in measured(texts).items()}
    return {**found, "fail_bits": fail_bits(found)}


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, every measurement and ``fail_bits``."""
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind, names = picked.schema["doc_id"].dataType.simpleString(), [*MEASURES, "fail_bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = _judged(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(found[n]) for n in names]], names=["doc_id", *names])

    return picked.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names))


def passes(mask: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0


def apply_policy(rows: DataFrame, version: str = CURRENT, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """Adds ``policy`` and ``kept`` to ledger rows."""
    return rows.withColumns({"policy": F.lit(version), "kept": passes(policies[version])})


def ablations(rows: DataFrame, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule it enforces: documents seen, kept, failing the rule, failing only it, kept without it.

    The documents are counted once per bit pattern (at most 2^rules rows after map-side
    combining); everything else is bit arithmetic on those counts.
    """
    counts = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
        for v, m in policies.items() for r in RULES if m >> r.bit & 1
    ])
    seen = counts.select("*", F.explode(cases).alias("c")).select("n", "c.*", F.col("fail_bits").bitwiseAND(F.col("c.mask")).alias("hit"))

    def total(where: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).cast("long").alias(name)

    fails = F.col("hit").bitwiseAND(F.col("bit")) != 0
    return seen.groupBy("policy", "rule", "bit").agg(
        F.sum("n").alias("documents"), total(F.col("hit") == 0, "kept"), total(fails, "failing"),
        total(F.col("hit") == F.col("bit"), "failing_only"), total((F.col("hit") == 0) | (F.col("hit") == F.col("bit")), "kept_without"),
    )


def keep_documents(docs: DataFrame, version: str = CURRENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns unchanged, whose bits the policy's mask passes; measured and judged in one pass."""
    mask = POLICIES[version]
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            yield part.filter(pa.array(_judged(part.column(at))["fail_bits"] & mask == 0))

    return docs.mapInArrow(run, docs.schema)
