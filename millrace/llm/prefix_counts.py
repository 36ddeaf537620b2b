"""Exact token counts of every prefix of a text, for a byte-level BPE tokenizer.

Within a pre-token, the encoding of a prefix ends in exactly one token, and what
stands before that token is the encoding of a shorter prefix. So a table over the
prefixes gives each one its last token and its count: the last token is the one
that ends there and may follow the last token of the prefix before it, which holds
if the merges leave the two side by side. A new pre-token starts a new table.

Counts are kept as differences from one character to the next, one signed byte
each. ``count_at`` and ``longest_within`` then answer for any cut without encoding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices, texts
from millrace.llm.encode import KNOWN_PIECES, LONGEST_KNOWN, Known, byte_of_character, held, ranks, spaced_alone, spaced_pieces

KNOWN_PAIRS = 1_000_000
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"] is not None:
            raise ValueError("prefix counts need a byte-level BPE tokenizer without normalizer")
        byte = byte_of_character()
        plain = lambda token: bytes(byte[c] for c in token)
        self.vocabulary = {plain(t): i for t, i in spec["model"]["vocab"].items() if all(c in byte for c in t)}
        self.token = {i: t for t, i in self.vocabulary.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merge = {(plain(a), plain(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.single = self._joined(spec["model"])
        self.ending = self._automaton()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.next_special = re.compile("|".join(map(re.escape, sorted(self.special))) or r"(?!)").search
        self.pretokens = regex.compile(public_tokenizers.PATTERN).findall
        self.side_by_side: dict[tuple[int, int], bool] = {}
        self.known = Known(self._learn, 600_000)
        self.words: dict[str, list[int]] = {}

    @staticmethod
    def _joined(model: dict) -> Callable[[bytes], list[int]] | None:
        """The ids of a run of bytes from tiktoken, if it joins them as the merges do."""
        import tiktoken

        table = ranks(model) if model["type"] == "BPE" else None
        if table is None:
            return None
        return tiktoken.Encoding("joined", pat_str=r"\S+", mergeable_ranks=table, special_tokens={})._encode_single_piece

    def _automaton(self):
        """Finds the tokens that end at each byte, in one pass; without those that the merges never leave."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for token, i in self.vocabulary.items():
            if token and self.parted(token) == [token]:
                found.add_word(token.decode("latin-1"), (len(token), i))
        found.make_automaton()
        return found.iter

    def parted(self, data: bytes) -> list[bytes]:
        return [self.token[i] for i in self.single(data)] if self.single else self.merged(data)

    def merged(self, data: bytes) -> list[bytes]:
        """Apply the merges to a short run of bytes, lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.merge.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def may_follow(self, before: int, token: int) -> bool:
        """Whether the merges leave the two tokens as they are; ``before`` -1 is the start of a pre-token."""
        key = (before, token)
        known = self.side_by_side.get(key)
        if known is None:
            parts = [self.token[token]] if before < 0 else [self.token[before], self.token[token]]
            if len(self.side_by_side) >= KNOWN_PAIRS:
                self.side_by_side.clear()
            known = self.side_by_side[key] = self.parted(b"".join(parts)) == parts
        return known

    def table(self, data: bytes) -> list[int]:
        """Token counts of all prefixes of one pre-token's bytes."""
        seen, may = self.side_by_side, self.may_follow
        counts, last, ends = [0], [-1], 0
        for at, (size, token) in self.ending(data.decode("latin-1")):
            if at < ends:  # this prefix has its token
                continue
            pair = (last[at + 1 - size], token)
            if seen[pair] if pair in seen else may(*pair):
                counts.append(counts[at + 1 - size] + 1)
                last.append(token)
                ends = at + 1
        return counts

    def pretoken(self, word: str) -> list[int]:
        """Token counts of the prefixes of one pre-token, by character."""
        found = self.words.get(word)
        if found is not None:
            return found
        counts = self._pretoken(word)
        if len(word) <= LONGEST_KNOWN:
            if len(self.words) >= KNOWN_PIECES:
                self.words.clear()
            self.words[word] = counts
        return counts

    def _pretoken(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        counts = self.table(data)
        if len(data) > len(word):
            ends = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).tolist()[1:] + [len(data)]
            counts = [0, *(counts[e] for e in ends)]
        if word in LONG_CONTRACTIONS:  # cut after its first letter, it is two pre-tokens
            counts[2] = counts[1] + self.table(data[1:2])[-1]
        return counts[1:]

    def ordinary(self, text: str) -> list[int]:
        """Token counts of the prefixes of a text without special strings."""
        out: list[int] = []
        total = run = 0
        blank = ""
        for word in self.pretokens(text):
            counts = self.pretoken(word)
            out.extend(total + c for c in counts)
            if blank and word[0].isspace():  # a cut between them leaves one run of white space
                out[-len(word)] = run + self.pretoken(blank + word[0])[-1]
            blank, run = (word, total) if word.isspace() else ("", total)
            total += counts[-1]
        return out

    def whole(self, text: str) -> np.ndarray:
        """Differences for a text with special strings or runs of white space."""
        counts, start, done = [], 0, 0
        while True:
            found = self.next_special(text, start)
            if found is None:
                counts += [done + c for c in self.ordinary(text[start:])]
                return np.diff(np.array([0, *counts]))
            at, string = found.start(), found.group()
            inside = self.ordinary(text[start : at + len(string) - 1])
            counts += [done + c for c in inside]
            done += (inside[at - start - 1] if at > start else 0) + 1
            counts.append(done)
            start = at + len(string)

    def _learn(self, pieces: list[str]) -> list[bytes | None]:
        out: list[bytes | None] = []
        for piece in pieces:
            if not spaced_alone(piece):
                out.append(None)
                continue
            words = self.pretokens(piece)
            out.append(self._steps(self.pretoken(piece) if len(words) == 1 else self.ordinary(piece)))
        return out

    @staticmethod
    def _steps(counts: list[int]) -> bytes:
        try:
            return bytes(map(sub, counts, [0, *counts]))
        except ValueError:  # a count that falls
            return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts)])

    def steps(self, texts: list[str]) -> list[bytes]:
        """For each text, one signed byte for each character: how much it adds to the token count."""
        cut = [spaced_pieces(t) if t and "\x00" not in t and not any(s in t for s in self.special) else None for t in texts]
        known = self.known.learn(set().union(*(c for c in cut if c)))
        out = []
        for text, pieces in zip(texts, cut):
            try:
                out.append(b"".join(map(known.__getitem__, pieces or ())) if pieces or not text else None)
            except TypeError:
                out.append(None)
            if out[-1] is None:
                out[-1] = self.whole(text).astype(np.int8).tobytes()
        return out


def prefix_counter(path: str) -> PrefixCounter:
    return held(PrefixCounter, path)


def count_at(steps: bytes, characters: int) -> int:
    """Tokens of the text's first ``characters`` characters."""
    return int(np.frombuffer(steps, np.int8, characters).sum())


def longest_within(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    counts = np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))
    return int(np.flatnonzero(counts <= budget)[-1])


def count_prefixes(docs: DataFrame, tokenizer: str, budget: int, with_steps: bool = False) -> DataFrame:
    """Token counts of whole texts, and the longest prefix within a budget, from the prefix tables.

    ``docs`` needs ``doc_id`` and ``text``; a null text counts as empty, ids may be null or
    repeated. Columns: doc_id, n_bytes, n_tokens, over_limit, budget_chars (characters
    of the longest prefix of at most ``budget`` tokens), and with ``with_steps`` the stored
    differences for ``count_at`` and ``longest_within``. No shuffle.
    """
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("budget_chars", pa.int64())]
    fields += [("steps", pa.binary())] * with_steps
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counter(tokenizer)
        for rows in slices(batches):
            steps: Sequence[bytes] = counter.steps(texts(rows))
            totals = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps]
            yield batch(
                {
                    "doc_id": rows.column("doc_id"),
                    "n_bytes": pc.fill_null(pc.binary_length(rows.column("text")), 0),
                    "n_tokens": totals,
                    "over_limit": [n > budget for n in totals],
                    "budget_chars": [longest_within(s, budget) if n > budget else len(s) for s, n in zip(steps, totals)],
                    "steps": steps,
                },
                schema,
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, budget_chars long" + ", steps binary" * with_steps
    return rows.mapInArrow(run, ddl)
