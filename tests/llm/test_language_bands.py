"""Bands of each language by itself, however many documents the table has."""

import random

from millrace.llm.encode import tokenizer_path
from millrace.llm.fertility import judged, with_features
from tests.llm.edge_rows import prose

MODEL = tokenizer_path("piece_bpe_32k.model")


def runic(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(chr(0x16A0 + rng.randrange(70)) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_each_language_has_its_own_bands(spark):
    rows = [(i, prose(7 + i, 200), "en") for i in range(300)] + [(1000 + i, runic(i, 150), "runes") for i in range(10)]
    rows += [(2000 + i, prose(900 + i, 1600), "en") for i in range(2)]
    numbers = " ".join(f"{random.Random(j).random():.12f}" for j in range(1000))
    rows.append((3000, numbers, "en"))  # the only one of its length
    rows.append((3001, runic(77, 150), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in judged(with_features(docs, MODEL)).collect()}
    assert all(kept[1000 + i] for i in range(10)) and all(kept[2000 + i] for i in range(2))
    assert sum(kept[i] for i in range(300)) >= 295
    assert not kept[3000] and not kept[3001]
