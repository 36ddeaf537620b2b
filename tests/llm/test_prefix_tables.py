"""Tables over the prefixes of a word: tokens that end at a byte come from one pass, pairs are tried without the merges in Python."""

import random

from millrace.llm.encode import tokenizer_path
from millrace.llm.prefix_counts import PrefixCounter


def test_tables_follow_the_merges():
    rng, counter = random.Random(8), PrefixCounter(tokenizer_path("byte_bpe_50k.json"))
    tokens = list(counter.vocabulary)
    for _ in range(3000):
        data = rng.choice(tokens) + rng.choice(tokens)
        assert counter.parted(data) == counter.merged(data)
    for _ in range(300):
        data = bytes(rng.choice(b"abcdehiotr\xc3\xa9") for _ in range(rng.randint(1, 25)))
        assert counter.table(data) == [len(counter.merged(data[:n])) for n in range(len(data) + 1)]


def test_tables_ask_only_for_tokens_that_are_there():
    counter, asked = PrefixCounter(tokenizer_path("byte_bpe_50k.json")), []

    class Asked(dict):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    counter.vocabulary = Asked(counter.vocabulary)
    counter.table(b"qz" * 200)
    assert len(asked) < 2000
