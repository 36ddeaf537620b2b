"""Encoders, token files, packing and prefix counts against the tokenizers library."""

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm.encode import LONGEST_RUN, Encoder, encoder, long_run, ranks, sure_characters, tokenizer_path
from millrace.llm.packing import pack
from millrace.llm.prefix_counts import PrefixCounter, count_at, count_prefixes, longest_within
from millrace.llm.token_files import EliasFano, TokenReader, read_token_files, token_folder, write_token_files
from tests.llm.edge_rows import edge_docs, no_docs

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = [
    "", "a  b", "\n", "x\n\ny", " lead", "tail ", "a\tb \t c", "hi <|endoftext|> x <|endoftext|><|endoftext|>", "don't we'll 's 'lla 've're", "a\x00b",
    "é ü x y z", "İstanbul ΣΑΣ Σ", "a\x1cb c", "日本語 テキスト 🙂👍🏽", "z" * 300 + " q", "12 345 6,789.00", "a<|endof", "é x", "y ́x",
]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def ids_of(path, texts, end):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids + [end] for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_library(path):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab 'lsr\n\t.=1é🙂vte<|") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    enc = encoder(path)
    got = [np.frombuffer(b, f"<u{enc.width}").tolist() for b in enc.encode(texts)]
    assert got == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_sure_character_is_read_alike(path):
    rng, enc, sure = random.Random(3), encoder(path), list(map(chr, sure_characters()))
    assert len(sure) > 30_000 and not {"\u03a3", "\u180e", "\u200b", "\x1c", "\x85"} & set(sure)
    few = [c for c in sure if ord(c) < 0x2100]
    texts = [f"a{c}b {c} {c}{c}\n{c}1 '{c} don't{c}  {c}" for c in sure]
    texts += ["".join(rng.choice(few) + rng.choice(["", "", " ", "'s", "e\u0301", "\n "]) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    assert all(enc.plain.takes(texts))
    got = enc.plain.encode(texts)
    for i in range(0, len(texts), 4000):
        library = enc.tokenizer.encode_batch(texts[i : i + 4000], add_special_tokens=False)
        assert got[i : i + 4000] == [e.ids for e in library]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ranks_join_as_the_merges_do(path):
    """Words glued from two or three tokens, where merges meet across the seams."""
    rng, enc = random.Random(4), encoder(path)
    tokens = [t.replace("</w>", "").replace("\u0120", " ") for t in enc.tokenizer.get_vocab(with_added_tokens=False)]
    tokens = [t for t in tokens if t.isascii()]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 3))) for _ in range(30_000)] + ["a" * n + "b" * (n % 7) for n in range(60)]
    assert enc.plain.encode(texts) == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def model(vocab, merges):
    base = list(ranks_base())
    names = base + vocab
    plain = {k: None for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "end_of_word_suffix")}
    return plain | {"type": "BPE", "vocab": {t: i for i, t in enumerate(names)}, "merges": merges}


def ranks_base():
    from millrace.llm.encode import byte_of_character

    return byte_of_character()


def test_unreached_tokens_have_no_rank():
    table = ranks(model(["aa", "ab", "aaa", "abb"], ["a a", "a b", "a aa", "ab b"]))
    assert b"aaa" not in table and {b"aa", b"ab", b"abb"} <= set(table)
    assert b"abc" not in ranks(model(["bc", "ab", "abc"], ["b c", "a b", "ab c"]))
    assert ranks(model(["ab", "abc"], ["ab c", "a b"])) is None  # ids do not ascend with the merges


def test_long_runs_are_told():
    assert long_run("x" * LONGEST_RUN) and long_run("a b" + " \t" * LONGEST_RUN) and long_run("a " * 700 + "y" * 1200)
    assert not long_run("") and not long_run("ab " * 5000) and not long_run("x" * (LONGEST_RUN - 1)) and not long_run("line\n" * 900)
    enc = Encoder(BYTES)
    texts = ["q" * 50_000, " " * 50_000, "ab" * 700 + " c", "\n" * 3000 + "d"]
    assert enc.plain.takes(texts) == [False] * 4
    assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_known_pieces_stay_bounded():
    enc = type(encoder(BYTES))(BYTES)
    enc.known.limit = 50
    texts = [f"word{i} and {i}" for i in range(500)]
    for i in range(0, 500, 20):
        enc._encode_cut(texts[i : i + 20])
        assert len(enc.known) > 0
        assert len(enc.known) <= 50 and len(enc.known.old) <= 50


def test_prefix_counts_are_exact_everywhere():
    rng, counter, tokenizer = random.Random(2), PrefixCounter(BYTES), Tokenizer.from_file(BYTES)
    texts = ODD + ["".join(rng.choice("ab 'lsr\n\t.=1é🙂vte<|") for _ in range(rng.randint(1, 25))) for _ in range(60)]
    for text, steps in zip(texts, counter.steps(texts)):
        assert len(steps) == len(text)
        counts = [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert [count_at(steps, i) for i in range(len(text) + 1)] == counts
        for budget in (0, 3, 10):
            assert longest_within(steps, budget) == max(i for i, c in enumerate(counts) if c <= budget)


def test_count_prefixes_edges(spark):
    docs = edge_docs(spark)
    got = sorted(map(tuple, count_prefixes(docs, BYTES, 100, with_steps=True).drop("steps").collect()), key=repr)
    tokenizer = Tokenizer.from_file(BYTES)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    sizes = [len(tokenizer.encode(t, add_special_tokens=False).ids) for _, t in rows]
    assert [(g[0], g[1], g[2], g[3]) for g in got] == sorted(((i, len(t.encode()), n, n > 100) for (i, t), n in zip(rows, sizes)), key=lambda x: repr(x))
    assert count_prefixes(no_docs(spark), BYTES, 100).collect() == []


@pytest.mark.parametrize("n, top", [(1, 0), (2, 5), (1000, 10), (1000, 10**6), (777, 10**12)])
def test_elias_fano_round_trip(n, top):
    values = np.sort(np.random.default_rng(1).integers(0, top + 1, n))
    code = EliasFano.load(EliasFano.of(values).dump())
    assert code.range(0, n).tolist() == values.tolist()
    assert [code.select(k) for k in range(n)] == values.tolist()
    assert code.range(n // 3, n // 2).tolist() == values[n // 3 : n // 2].tolist()
    assert len(code.low) + len(code.high) <= n * (2 + max(1, int(top / n).bit_length())) / 8 + 16


def test_token_files(spark):
    docs = edge_docs(spark)
    folder = token_folder(spark)
    files = write_token_files(docs, folder, WORDS, 2)
    got = sorted(map(tuple, read_token_files(spark, folder, files).collect()), key=lambda r: r[1])
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, want = 0, []
    for (i, _), ids in zip(rows, ids_of(WORDS, [t or "" for _, t in rows], 2)):
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    name = files.first().file
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{path}/{name}") as source:
        reader = TokenReader(source)
        assert [reader.start(k) for k in range(reader.n_docs + 1)] == reader.boundaries.range(0, reader.n_docs + 1).tolist()


def test_no_token_files(spark):
    folder = token_folder(spark)
    assert read_token_files(spark, folder, write_token_files(no_docs(spark), folder, WORDS, 2)).collect() == []


@pytest.mark.parametrize("length", [16, 2048])
def test_packing(spark, length):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = collections.Counter((i, len(ids), crc(ids)) for (i, _), ids in zip(rows, ids_of(BYTES, [t for _, t in rows], 1)))
    pieces = sorted(pack(docs, BYTES, 1, length).collect(), key=lambda p: (p.sequence_id, p.offset))
    place, open_doc, found = 0, None, collections.Counter()
    known = {(i, len(ids)): ids for (i, _), ids in zip(rows, ids_of(BYTES, [t for _, t in rows], 1))}
    for p in pieces:
        assert p.sequence_id * length + p.offset == place and p.offset + p.length <= length
        if p.start:
            assert open_doc == (p.doc_id, p.doc_tokens, p.start)
        assert crc(known[p.doc_id, p.doc_tokens][p.start : p.start + p.length]) == p.ids_crc32
        open_doc = (p.doc_id, p.doc_tokens, p.start + p.length)
        place += p.length
        if p.start + p.length == p.doc_tokens:
            found[p.doc_id, p.doc_tokens, crc(known[p.doc_id, p.doc_tokens])] += 1
    assert found == want
    assert pack(no_docs(spark), BYTES, 1).collect() == []
