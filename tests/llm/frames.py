"""Small tables with the awkward cases every operator has to take."""

import random

LONG = "wide open fields " * 40_000
WORDS = [a + b for a in ("ka", "lo", "mi", "ten", "ur", "sha") for b in ("den", "fa", "gol", "pir", "st", "vem")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows():
    """(doc_id, text, lang): nulls, empty and very long texts, ties, repeated rows."""
    return [
        (1, prose(1, 60), "aa"),
        (2, prose(1, 60), "aa"),  # the same text again
        (3, prose(1, 58) + " other ends", "aa"),
        (4, None, "aa"),
        (5, "", None),
        (6, " \t\n ", "bb"),
        (7, LONG, "bb"),
        (8, prose(8, 40), "bb"),
        (8, prose(8, 40), "bb"),  # the same row again
        (None, prose(9, 30), "bb"),
        (None, None, None),
        (10, "日本語のテキスト。" * 30 + "  x", None),
        (11, "!!! 123 <|endoftext|> it's", "aa"),
    ]


def documents(spark, data=None):
    """With further columns whose names operators use for themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, a long, n int, node long, label string, rep long"
    data = rows() if data is None else data
    return spark.createDataFrame(
        [(i, t, g, "s", len(t or ""), 0.5, "k", 7, 1, 3, "l", 9) for i, t, g in data], schema
    )
