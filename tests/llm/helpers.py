"""Plain versions of the operators, to compare with."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def frame(spark, rows, extra: bool = True):
    """Documents from (id, text) pairs, with clashing and unneeded columns."""
    schema = "doc_id long, text string" + (", row string, key long, kept string, start int" if extra else "")
    return spark.createDataFrame([(i, t, *(["x", 1, "y", 2] if extra else [])) for i, t in rows], schema)


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    stems = ["".join(draw.choices(["th", "er", "on", "an", "re", "é", "ß", "st", "ing"], k=draw.randint(1, 4))) for _ in range(vocabulary)]
    return draw.choices(stems, k=n)


class Union:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
