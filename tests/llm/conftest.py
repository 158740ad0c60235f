from __future__ import annotations

import random

import pytest

from panelwright.llm.common import importable

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, _row int, tokens string, node string"


@pytest.fixture(scope="session", autouse=True)
def ready(spark):
    importable(spark)


def prose(rnd: random.Random, words: int) -> str:
    letters = "abcdefghijklmnopqrstuvwxyzäé"
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows, ids that repeat, and columns with clashing names."""
    rnd = random.Random(5)
    long = prose(rnd, 6000)
    body = prose(rnd, 120)
    near = body.split()
    near[3] = "changed"
    rows = [
        (0, body, "en", "a", 1, "s", 1, "t", "n"),
        (1, " ".join(near), "en", "b", 2, None, None, None, None),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, "x", 2, "t", "n"),
        (4, " \t\n\x0b\x0c\r ", "en", "b", 7, "x", 2, "t", "n"),
        (5, long, "de", None, len(long), "x", 3, "t", "n"),
        (5, long, "de", None, len(long), "x", 3, "t", "n"),
        (5, body + " and more words", "de", "c", 9, "x", 3, "t", "n"),
        (None, body, "fr", "a", 4, "x", 3, "t", "n"),
        (None, "short text", "fr", "é", 4, "x", 3, "t", "n"),
        (6, "one two", "fr", "a", 4, "x", 3, "t", "n"),
        (7, "a a a a a a a a a a a a", "fr", "a", 4, "x", 3, "t", "n"),
        (8, "non\xa0breaking\x1cspace   日本語 é 😀😀 <|endoftext|> İ", "xx", "b", 4, "x", 3, "t", "n"),
        (-9, prose(rnd, 300), "xx", "b", 4, "x", 3, "t", "n"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
