"""Small odd tables for the operators' tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = DOCS + ", h long, node string, key string, kept string, line int, root long, size string, score string, row int"
INNER = ["_row", "_ROW_", "_gone", "_doc", "_node", "_more", "_block", "_need_0", "_n_words", "_lost_chars", "kept_place", "_end"]
EXTRA += "".join(f", {c} long" for c in INNER)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    luck = random.Random(seed)
    words = [luck.choice(WORDS) + luck.choice("abcdefghij") for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, n, 12)) + "."


def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with names like any other."""
    texts = [None, "", "   \n\t\n", "One two.", prose(1, 60), prose(1, 60), prose(2, 60), "x" * 30_000, prose(3, 20_000), "\n".join([prose(4, 30)] * 5)]
    rows = [(i, t, "en", f"src{i % 2}", len(t or ""), 1, "n", "k", None, 2, 3, "s", "z", 1, *range(i, i + len(INNER))) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, prose(5, 40), None, None, None, *[None] * (9 + len(INNER))), (None, None, None, None, None, *[None] * (9 + len(INNER)))]
    return spark.createDataFrame(rows, EXTRA)


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
