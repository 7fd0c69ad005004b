from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label long, base string, tokens string, comp long, _row string, size long, html string"


def prose(rng: random.Random, n: int) -> str:
    syllables = "ba ce di fo gu la me ni po ru sa te vi wo ly an er in on st".split()
    return " ".join("".join(rng.choices(syllables, k=rng.choice((1, 2, 3)))) for _ in range(n))


def hard_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, extra columns with names that clash."""
    rng = random.Random(11)
    one, two, long = prose(rng, 80), prose(rng, 200), prose(rng, 60_000)
    texts = [(1, one), (2, None), (3, ""), (4, one), (4, one), (5, long), (6, " \t\n  "), (None, two), (None, None), (7, two + " end"), (8, "a"),
             (9, "x" * 30_000), (10, "é😀 " * 50 + " "), (11, one.replace("ba", "ti", 1)), (4, two), (12, "1234 5678"), (13, two)]
    return [(i, t, None if k % 4 == 3 else "en", None if k % 5 == 4 else "s", None if t is None else len(t), 1, "x", None, 7, "r", 3, "h") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")
