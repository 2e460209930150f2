"""Awkward tables that every operator must take."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"{a}{b}{c}" for a in "kmnprst" for b in "aeiou" for c in ("", "l", "n", "sh")]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empties, a very long text, repeated rows, equal keys, odd bytes."""
    long = prose(1, 30_000)
    rows = [
        (1, "One two three. Four, five!\nOne two three.", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "  \t\n \r\x0b\x0c ", "en", "b", 1),
        (None, "no key but some words here and there", "en", "b", 1),
        (5, long, "en", "hot", 1),
        (6, prose(2, 300), "fr", "hot", 1),
        (6, prose(2, 300), "fr", "hot", 1),
        (6, prose(3, 120), "fr", "hot", 1),
        (7, "\u00c9t\u00e9 \u0130stanbul \u03a3\u0391\u03a3 stra\u00dfe <|endoftext|>x don't \U0001f600 a\u00a0b e\u0301", "xx", "c", 1),
        (8, "z" * 5000, "en", "c", 1),
        (9, "ab" * 700, "en", "c", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns with the names that operators give to their results."""
    from pyspark.sql import functions as F

    names = "n_tokens shard size start end score kept spans item key part gram place text_crc32 rule host u v n".split()
    return awkward.withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
