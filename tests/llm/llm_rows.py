"""Small tables with every awkward row: NULLs, empty and long texts, repeats, clashing extra columns."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, part int, node long, rank int"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); the other columns clash with names the operators use."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 9.0, 9, 9, 9) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def sentence(rng: random.Random, n: int, words: int = 400) -> list[str]:
    return [f"w{rng.randrange(words)}" for _ in range(n)]
