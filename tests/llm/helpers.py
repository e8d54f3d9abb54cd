"""Small tables for the tests of this folder."""

import math
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, texts: dict | list) -> DataFrame:
    """A documents table from texts by id, or from (id, text) pairs."""
    pairs = texts.items() if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in pairs], DOCUMENTS)


def prose(seed: int, words: int, kinds: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(kinds)}x" for _ in range(words))


#: every awkward text at once: NULL, empty, blank, short, wide characters, very long, repeated rows
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "Straße ▁ 日本語 🙂 \u0000 naïve"),
    (6, prose(6, 30_000)),
    (7, prose(7, 60)),
    (7, prose(7, 60)),
    (None, prose(8, 60)),
    (None, None),
    (9, "x" * 5_000),
    (10, "<|endoftext|> a  b\n\n c "),
]


def rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]

VECTORS = "vec_id long, embedding array<float>, label int, row string, values string, id string"


def vectors(spark: SparkSession, items: list[tuple]) -> DataFrame:
    """An embeddings table from (id, vector, label), with further columns under names that operators use."""
    return spark.createDataFrame([(i, v, k, "r", "v", "i") for i, v, k in items], VECTORS)


def drawn_vectors(seed: int, count: int, width: int, groups: int = 4, labels: int = 3) -> list[tuple]:
    """Rough vectors around a few directions, so that scores tie and near copies exist."""
    draw = random.Random(seed)
    centers = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(groups)]
    return [(i, [round(c + draw.gauss(0, 0.4), 1) for c in draw.choice(centers)], draw.randrange(labels)) for i in range(count)]


#: vectors that take no part, and odd ones that do: zeros, ties, rows and keys that repeat, a NULL key
ODD_VECTORS = [
    (100, None, 1),
    (101, [1.0, None, 0.0], 1),
    (102, [float("nan"), 0.0, 0.0], 1),
    (103, [float("inf"), 0.0, 0.0], 1),
    (104, [3e30, 0.0, 0.0], 1),
    (150, [0.0, 0.0, 0.0], 1),
    (105, [1.0, 0.5, 0.25], 2),
    (106, [1.0, 0.5, 0.25], 2),
    (50, [1.0, 0.5, 0.25], 2),
    (50, [1.0, 0.5, 0.25], 2),
    (50, [0.5, 0.5, -0.25], 1),
    (None, [1.0, 0.5, 0.25], 1),
    (None, [0.9, 0.6, 0.2], None),
    (7, [0.9, 0.6, 0.2], 9),
    (14, [0.8, 0.7, 0.1], 2),
]


def whole_numbers(items: list[tuple], scale: int = 256) -> list[tuple]:
    """(id, integers, label) of the vectors that take part."""
    kept = []
    for key, vector, label in items:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            ints = [math.floor(float(np.float32(x)) * scale) for x in vector]
            if sum(x * x for x in ints) < 2**60:
                kept.append((key, ints, label))
    return kept


def inner(a: list[int], b: list[int]) -> int:
    return sum(x * y for x, y in zip(a, b))
