"""Small frames for the tests of the corpus operators."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, *texts, first=1):
    """Documents numbered from ``first``; a text may be None."""
    return spark.createDataFrame(
        [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(2 + rng.randrange(6))) + str(rng.randrange(vocabulary))
                    for _ in range(words))
