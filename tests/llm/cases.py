"""Awkward documents that every operator must get through."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "fp long, k long, y string, size string, copies int, spans string, component_id string, lang_pred int, kept_id int"
)
LONG = "lorem ipsum dolor sit amet " * 12_000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "de", "b"),
    (5, LONG, "en", "b"),
    (6, LONG, "en", "c"),
    (None, "no id at all, and a word: éßñ 漢字 😀", None, "c"),
    (None, None, None, None),
    (7, "123 456 --- !!!", "fr", "d"),
    (8, "x" * 50_000, "fr", "d"),
    (-9, "password = hunter2hunter2 <|endoftext|>", "es", "\U0001f600"),
]


def documents(spark, rows=ROWS):
    """``rows`` with columns whose names operators use inside."""
    extra = (7, 7, "y", "s", 7, "spans", "c", 7, 7)
    data = [(i, t, lang, s, None if t is None else len(t), *extra) for i, t, lang, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)




def words(rng: random.Random, n: int, alphabet: str = "etaoinshrdlu") -> str:
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 8))) for _ in range(n))
