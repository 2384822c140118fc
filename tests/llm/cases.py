"""Small tables with every awkward row, shared by the tests of this folder."""
from __future__ import annotations

import random

from pyspark.sql import functions as F

WORDS = "the of and river stone light paper green table window garden letter music number story travel winter simple market bridge".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("h1", "h2", "n", "th", "rank", "size", "shard", "key", "__doc", "__text", "__part", "label", "group", "component", "node")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ly", ",", "."]) for _ in range(n))


def rows(n: int = 60, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for k in range(n):
        text = "\n".join(prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 6))) + "\n Shared LINE \n"
        out.append((k, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None]), len(text)))
    base = prose(rng, 200)
    for k in range(12):  # near copies and exact copies
        words = base.split()
        if k % 3:
            words[rng.randrange(len(words))] = f"changed{k}"
        out.append((n + k, " ".join(words), "en", "a", 0))
    long = prose(rng, 6000)
    out += [(200, None, "en", "a", None), (201, "", "de", "b", 0), (202, "  \t\n\n ", "en", "a", 6), (203, long, "en", "b", len(long)),
            (204, "one", "en", "a", 3), (205, "ONE", "en", "a", 3), (206, "one two", "en", None, 7), (207, "\x0b\x0cone two\r", "en", "a", 9),
            (None, "a text without an id", "en", "a", 0), (None, None, None, None, None), out[0], out[0], (208, base, "en", "a", 0)]
    return out


def documents(spark, data=None, clashing: bool = False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text) -> list[bytes]:
    return (text or "").encode().split()
