"""Small tables with every odd case, and plain definitions to compare with."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, row int, size int, id int, th int, shard int, n_words int, score int, hash int, component int, bucket int"


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(LOWER))


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary):x}" + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))


def odd_texts() -> list[tuple]:
    """(doc_id, text, lang, source): NULLs everywhere, empty and very long texts, ties, repeated rows and ids, near copies."""
    base = prose(1, 300).split(" ")
    near = [*base[:150], "changed", *base[151:]]
    rows = [
        (1, " ".join(base), "en", "a"),
        (2, " ".join(base), "en", "b"),
        (3, " ".join(near), None, "a"),
        (4, None, "en", "a"),
        (5, "", "de", None),
        (6, " \t\n ", None, None),
        (7, "Zwei Wörter", "de", "b"),
        (8, prose(2, 40_000, 5000), "en", "c"),
        (8, "same id, other text", "en", "c"),
        (None, "no id at all", "en", "a"),
        (None, None, None, None),
        (9, "repeated row " * 30, "en", "c"),
        (9, "repeated row " * 30, "en", "c"),
        (10, "😀 emoji | # $ and\x0bvertical\x0ctabs\r\nline\nline\nline", "fr", "a"),
        (11, "a b a b a b a b c", "fr", ""),
        (12, "!!! ... ---", "fr", "b"),
    ]
    return rows + [(100 + i, prose(100 + i % 40, 60 + i), "en", f"s{i % 4}") for i in range(80)]


def table(spark, rows=None):
    """Documents with extra columns whose names clash with those that operators use inside."""
    full = [(*r, len(r[1] or ""), *([7] * 11)) for r in (odd_texts() if rows is None else rows)]
    return spark.createDataFrame(full, SCHEMA)


def plain(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
