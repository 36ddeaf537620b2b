"""Small tables with the rows that break things: nulls, empty and very long texts, repeats, and columns with clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars int, rep long, label string, start long, host string, part int, _id long"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["an", "the", "or", "ti", "ré", "sch", "o"]) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", ".\n"])[:2].strip(" ") for _ in range(words)).replace("\n ", "\n")


def edge_docs(spark):
    long = prose(1, 30_000)
    texts = [
        (0, prose(2, 120)),
        (1, prose(2, 120)),
        (1, prose(2, 120)),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, "one"),
        (None, prose(2, 120)),
        (None, None),
        (6, long),
        (7, long + " more"),
        (8, "a b " * 200),
        (9, "日本語 テキスト 🙂 <|endoftext|> x\x00y  z\n\n" * 20),
    ]
    rows = [(i, t, "en" if n % 3 else None, None, None if t is None else len(t), 1, "x", 2, "h", 3, 4) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
