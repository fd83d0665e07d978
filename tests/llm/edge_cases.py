import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, fp string, key string, ids string, score string, h string, slot string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


def rows_to_docs(spark, rows):
    """Documents ``(doc_id, text)`` with further columns whose names the operators use themselves."""
    full = [(i, t, None, "s", None if t is None else len(t), "clash", "clash", "clash", None, "clash", "clash", "clash") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


EDGE = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "two words"), (6, prose(1, 120)), (7, prose(1, 120)), (8, prose(1, 60) + " " + prose(2, 70)),
    (9, "x" * 5000), (10, "same " * 300), (11, "Ünï çødé 𝔘 ▁ 　 " * 30), (12, "\n".join(["a line of text that is long enough to be counted here"] * 3)),
    (13, prose(3, 30_000)), (14, prose(4, 80)), (14, prose(4, 80)), (None, prose(1, 120)), (None, None),
]


@pytest.fixture(scope="session")
def edge(spark):
    return rows_to_docs(spark, EDGE).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return rows_to_docs(spark, []).repartition(1)
