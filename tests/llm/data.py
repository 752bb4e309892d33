"""Small documents with the cases every operator has to bear."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, words string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("kamotiresulin") for _ in range(r.randint(2, 8))) for _ in range(n))


def rows() -> list[tuple]:
    """NULL, empty and blank texts, repeated rows and ids, copies, a long text,
    NULL ids and sources, non-ASCII words, extra columns whose names clash."""
    base = prose(1, 80)
    texts = [
        (1, base), (2, base), (2, base), (3, base + " tail"), (4, None), (5, ""), (6, "  \n "), (7, "One"),
        (8, "one TWO"), (9, "Äpfel ÉTÉ naïve"), (10, prose(2, 9000)), (11, prose(3, 40)), (11, prose(4, 40)),
        (None, prose(5, 30)), (None, None), (12, "a a a a a a a a a a a a a a a a a a a a"), (13, prose(6, 60)),
    ]
    return [(i, t, "en" if k % 2 else None, ("s1", "s0", None)[k % 3], None if t is None else len(t), "x", None)
            for k, (i, t) in enumerate(texts)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
