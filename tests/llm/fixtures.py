"""Small tables with the cases that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, bucket string, id string, part string, __row string"


def words(rng: random.Random, n: int, sep: str = " ") -> str:
    return sep.join("".join(rng.choice("aeioubdfgklmnprst") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Ids, texts, languages and sources; other columns clash with names that operators use."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        (1, base, "en", "a"), (2, base, "en", None), (3, " ".join(near), "de", "a"), (4, base.upper(), "en", "b"),
        (5, None, "en", "a"), (6, "", None, "b"), (7, " \t\n\x0b", "de", "a"), (8, "one", "en", "a"), (9, "ONE two", "en", "c"),
        (10, words(rng, 6000), "de", "a"), (11, "x" * 30_000, "de", "c"), (12, words(rng, 40, "\n"), None, "a"),
        (None, base, "en", "a"), (None, None, None, None), (13, "漢字 かな 🙂 \x00 ▁▁ é́", "ja", "b"),
        (14, words(rng, 90), "en", "a"), (14, words(rng, 90), "en", "a"), (15, "tie tie", "en", "a"), (16, "tie tie", "en", "a"),
        (1, base, "en", "a"), (17, "1234 5678 !!", "en", "a"), (18, base + "\n" + words(rng, 30), "en", "a"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None, -1, "x", "y", "z", "w") for i, t, lang, s in texts]


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def plain(spark, texts, **more):
    """Documents 0, 1, 2 and so on with these texts."""
    rows = [(i, t, more.get("lang", "en"), more.get("source", "a"), len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
