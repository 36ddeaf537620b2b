"""Ranked lexical search against scoring every document."""

import math
import random
import re

import pytest

from millrace.llm.lexical import Best, Part, PartBuilder, Statistics, ranked, search_part, terms, units, weight, with_impacts
from tests.llm.edge_rows import edge_docs, no_docs

ITEMS = "item_id long, text string, rank int, doc_id long, score long, term string"


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in rows], ITEMS)


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def plain_ranks(docs, items, k=10):
    held = [(i, t) for i, t in ((i, plain_terms(t)) for i, t in docs) if t]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    queries = {}
    for i, t in items:
        if t is not None:
            queries.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, words in queries.items():
        scored = []
        for doc_id, t in held:
            m = 100 - 90 + (90 * len(t) * n_docs) // length
            score = 0
            for w in words:
                if tf := t.count(w):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n, vocabulary=80):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(words, weights, k=rng.choice([1, 3, 10, 40, 200]))) for _ in range(n)]


def test_terms():
    assert terms("Ab1-c_D été ÉTÉ\x00x\n日本 😀!") == ["ab1", "c", "d", "été", "ÉtÉ", "x", "日本", "😀"]
    for text in ("", "  ", "İSTANBUL ẞ ǅ", "a`b{c~d\x7fe"):
        assert terms(text) == plain_terms(text)


@pytest.mark.parametrize("part_bytes, block_bytes", [(16 << 20, 16 << 20), (3000, 16 << 20), (800, 300)])
def test_ranks_match_scoring_everything(spark, part_bytes, block_bytes):
    docs = [(i, t) for i, t in enumerate(corpus(1, 300))] + [(i + 300, "w1 w2 w7") for i in range(25)]  # ties beyond the tenth
    items = [(i, t) for i, t in enumerate(corpus(2, 15))] + [(90, "w1 w2"), (91, "unseen words"), (92, None), (93, ""), (94, " ,;"), (3, "w7 w9")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = ranked(df, items_frame(spark, items), 10, block_bytes, part_bytes).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_ranks(docs, items)


def test_edge_documents(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(1, "an the or ti"), (1, "an the or ti"), (None, "one b A x y 日本語"), (2, "schan thean"), (3, "more endoftext")]
    got = ranked(docs, items_frame(spark, items), 10).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_ranks(rows, items)


def test_empty_tables(spark):
    some = items_frame(spark, [(1, "a b")])
    assert ranked(no_docs(spark), some).collect() == []
    assert ranked(edge_docs(spark), items_frame(spark, [])).collect() == []
    assert ranked(edge_docs(spark), items_frame(spark, [(1, None), (2, "!?")])).collect() == []


def built(texts, items):
    builder = PartBuilder(None)
    for i, t in enumerate(texts):
        builder.add(i, t)
    n, length = builder.documents, builder.length
    row = builder.row().to_pylist()[0]
    df = {t: b - a for t, a, b in zip(row["terms"], row["starts"], row["starts"][1:])}
    known = Statistics(n, length, {t: weight(n, d) for t, d in df.items()})
    return Part.of(with_impacts(row, known, items))


def test_pair_bounds_are_bounds_and_skip_more():
    rng = random.Random(6)
    texts = []
    for i in range(3000):  # two words that are strong in different documents, and hardly meet
        own = ["red " * 6 if i % 2 else "blue " * 6] if i % 3 == 0 else []
        texts.append(" ".join([*own, *rng.choices([f"x{j}" for j in range(60)], k=30)]))
    texts += ["zone zone zone x1 x2 x3"] * 200
    item = "red blue zone".split()
    part = built(texts, [item])
    wanted = [part.number[t] for t in item]
    paired, single = units(part, wanted), units(part, wanted, paired=False)
    assert sum(b for b, _ in paired) < sum(b for b, _ in single)
    for bound, members in paired:
        sums = {}
        for t in members:
            for o, s in zip(part.ords[t].tolist(), part.impacts[t].tolist()):
                sums[o] = sums.get(o, 0) + s
        assert max(sums.values()) <= bound
    with_pairs, without = Best(10), Best(10)
    few, many = search_part(part, item, with_pairs), search_part(part, item, without, paired=False)
    assert with_pairs.rows == without.rows
    assert few == 200 < 600 < many
