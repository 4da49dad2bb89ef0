"""Small inputs shared by the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["th", "er", "on", "an", "re", "in", "ou", "ble", "ing", "tion"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def doc(i, text):
    return (i, text, "en", "src", None if text is None else len(text))


def messy_rows() -> list[tuple]:
    """Nulls, empty and white-space texts, a very long text, repeated rows and ids."""
    rng = random.Random(7)
    plain = " ".join(words(rng, 60))
    return [doc(1, None), doc(2, ""), doc(3, " \t\n "), doc(4, "one"), doc(5, plain), doc(5, plain), doc(6, plain),
            doc(None, plain), doc(None, None), doc(7, " ".join(words(rng, 30_000))), doc(8, "ÉÀ ß 中文 \U0001f600 x"),
            (9, "a b c", None, None, None), doc(10, "<|endoftext|> it's 0")]


def messy(spark):
    return spark.createDataFrame(messy_rows(), DOCS)


#: names that operators use inside
CLASHING = ["row", "uid", "text_b", "key", "node", "length", "piece", "score", "spans", "hits", "items", "shard",
            "slot", "rank", "_uid", "_text", "kept", "n", "kind", "pattern", "word", "gram"]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
