"""Small documents with every awkward case, and brute-force versions."""

from __future__ import annotations

import random
import re

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, schema=DOCUMENT):
    """Rows with ids 0.. unless given as (id, text)."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], schema)


def clashing(df):
    """Further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    names = ["key", "bucket", "row", "score", "label", "matches", "n_words", "class_id", "told", "kinds", "n_mentions", "c0", "mark", "offset", "start"]
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


def prose(n, seed=0, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
