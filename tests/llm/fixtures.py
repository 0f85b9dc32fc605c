"""Small tables with the awkward rows every operator must take."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}
#: documents columns plus extra ones whose names operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, key string, part int, "
          "shard int, start long, n long, row long, a string, node long, position double, spans string")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["th", "an", "in", "er", "on", "ti", "es", "or"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.05 else "") for w in words)


def texts() -> list[tuple]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "CHANGED"
    shared = prose(2, 60)
    out = [(1, base, "s1"), (2, base, "s1"), (3, " ".join(near), "s2"), (4, None, "s1"), (5, "", None), (6, "one", "s2"),
           (7, "two words", None), (8, prose(3, 5000), "s3"), (9, prose(4, 90) + " " + shared, "s1"),
           (10, shared + " " + prose(5, 80), "s2"), (11, "ein Größe Wort " + prose(6, 40), "s3"),
           (None, base, "s1"), (None, None, None), (12, prose(7, 50), "s2"), (12, prose(7, 50), "s2"), (12, prose(8, 50), "s2"),
           (13, " \n\t ", "s1"), (14, "a " * 200, "s1"), (15, "line of text here\n" * 30, "s2"), (2 ** 40, prose(9, 70), "s9")]
    return out + [(100 + i, prose(20 + i, 60), f"s{i % 4}") for i in range(30)]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", s, len(t or ""), 7, "k", 1, 2, 3, 4, 5, "x", 6, 0.5, "y") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(AZ) if lower else text)
