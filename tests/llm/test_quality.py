"""Fertility features against plain counting, and what the bands keep."""

import collections
import math
import random

import pyarrow as pa
import sentencepiece

from millrace.llm.encode import for_task, tokenizer_path
from millrace.llm.fertility import Bands, Pieces, duplicate_lines, judged, keep_good, measure, repeated_words, with_features
from tests.llm.edge_rows import edge_docs, no_docs, prose

MODEL = tokenizer_path("piece_bpe_32k.model")


def brute_repeats(words):
    runs = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    return len({j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)})


def test_repeated_words():
    rng = random.Random(3)
    for n in range(300):
        words = [rng.choice([b"a", b"b", b"cc"]) for _ in range(rng.randint(0, 60))]
        if n % 2:
            words = [str(rng.random()).encode() for _ in words]
            words += words[: rng.randint(0, 12)]
        assert repeated_words(words) == brute_repeats(words)


def test_duplicate_lines():
    assert duplicate_lines("a\nb\na\n\n\n \na") == 2
    assert duplicate_lines("") == 0


def test_measures_equal_plain_counting():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [prose(5, 80), "x # $\x0by &é　z", "", " \n", "日本語 🙂 ÿ"]
    got = measure(texts, Pieces(MODEL))
    for n, text in enumerate(texts):
        words = text.replace("\x0b", " ").split(" ")
        words = [w for line in words for w in line.split("\n") if w]
        ids = [i for w in words for i in model.encode(w)]
        assert got["n_words"][n] == len(words) and got["word_chars"][n] == sum(map(len, words))
        assert got["n_symbols"][n] == sum(text.count(c) for c in "#*$%&|<>")
        assert got["n_tokens"][n] == len(ids)
        if ids:
            shares = [c / len(ids) for c in collections.Counter(ids).values()]
            assert math.isclose(got["entropy"][n], -sum(s * math.log2(s) for s in shares), abs_tol=1e-9)
            assert math.isclose(got["byte_share"][n], sum(model.is_byte(i) for i in ids) / len(ids))
            assert math.isclose(got["chars_per_token"][n], sum(map(len, words)) / len(ids))
        else:
            assert got["entropy"][n] is None and got["chars_per_token"][n] is None


def test_bands_reject_numbers_and_keep_prose(spark):
    good = [(i, prose(7 + i, 200), "en", 0) for i in range(120)]
    bad = [(1000 + i, " ".join(f"{random.Random(i * 300 + j).random():.12f}" for j in range(60)), "en", 1) for i in range(6)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, bad int")
    rows = judged(with_features(docs, MODEL), bands=Bands(few=20)).collect()
    assert all(not r.kept for r in rows if r.bad)
    assert sum(r.kept for r in rows if not r.bad) >= 118
    kept = keep_good(docs, MODEL, Bands(few=20))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_edges(spark):
    docs = edge_docs(spark)
    rows = judged(with_features(docs, MODEL, "_x_"), prefix="_x_").collect()
    assert len(rows) == docs.count()
    assert all(r["_x_base_failed"] and not r["_x_kept"] for r in rows if not (r.text or "").strip())
    assert keep_good(no_docs(spark), MODEL).collect() == []
    assert keep_good(docs, MODEL).columns == docs.columns


def test_a_task_leaves_nothing_learned_in_its_worker(spark):
    docs = spark.createDataFrame([(n, prose(n, 60), "en") for n in range(40)], "doc_id long, text string, lang string").repartition(4)
    with_features(docs, MODEL).collect()

    def learned(batches):
        from millrace.llm import encode

        for rows in batches:
            yield pa.RecordBatch.from_pydict({"n": [sum(len(m.known) + len(m.known.old) for _, _, m in encode._held)]})

    assert {r["n"] for r in spark.range(0, 64, 1, 8).mapInArrow(learned, "n long").collect()} == {0}


def test_a_failed_task_forgets_too():
    try:
        with for_task(Pieces, MODEL) as model:
            measure([prose(1, 50)], model)
            assert model.known
            raise KeyError
    except KeyError:
        assert not model.known and not model.known.old
