"""Token ids of whole texts by a public tokenizer, with the ids of known words kept in the worker.

Most texts go through tiktoken as a whole, with ranks made from the tokenizer's own
merges (``ranks``). That gives the ids of the tokenizers library where both read every
character alike, which ``Plain`` decides.

Other texts are cut where the tokenizer's own pre-tokenizer always cuts: at a single
space or line break between two characters that are not white space. Each
different piece goes through the tokenizers library once per worker; a text's ids
are the ids of its pieces joined. Texts that cannot be cut this way (runs of white
space, special strings, zero bytes) go through the library as a whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.batches import release

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

KNOWN_PIECES = 500_000
LONGEST_KNOWN = 64
LONGEST_RUN = 1000
WORD_END = "\x01"
_SEPARATORS = re.compile("[\x1c-\x1f]")
_RUN = re.compile(r"\s{%d}|\S{%d}" % (LONGEST_RUN, LONGEST_RUN))


class Known(dict):
    """What pieces map to, computed for many new pieces at once.

    Holds at most two generations of ``limit`` pieces each: when the young one is
    full it becomes the old one, and pieces still in use move back.

    ``compute`` takes a list of pieces and returns their values; None marks a piece
    that must not be used alone.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = KNOWN_PIECES):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def learn(self, pieces: set[str]) -> dict:
        """Add the pieces; returns the mapping to use for this batch."""
        new = [p for p in pieces if p not in self]
        if len(self) + len(new) > self.limit:
            self.old = dict(self)
            self.clear()
            new = list(pieces)
        values = {p: self.old[p] for p in new if p in self.old}
        rest = [p for p in new if p not in values]
        values.update(zip(rest, self.compute(rest)))
        self.update((p, v) for p, v in values.items() if len(p) <= LONGEST_KNOWN)
        if all(len(p) <= LONGEST_KNOWN for p in new):
            return self
        return values | {p: self[p] for p in pieces if p in self}

    def forget(self) -> None:
        self.clear()
        self.old = {}


def spaced_pieces(text: str) -> list[str]:
    """Words with the space before them, and line breaks; of a byte-level tokenizer that keeps spaces."""
    return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")


def spaced_alone(piece: str) -> bool:
    body = piece[1:] if piece[:1] == " " else piece
    return piece == "\n" or bool(body) and not body[0].isspace() and not body[-1].isspace()


def bare_pieces(text: str) -> list[str]:
    """Words; of a tokenizer that drops white space."""
    return text.split()


def byte_of_character() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks(model: dict) -> dict[bytes, int] | None:
    """Token bytes and their ids, for an encoder that joins the pair whose bytes have the lowest id.

    It gives what the merges give if ids ascend with the merges and every token is what
    its own bytes are merged into; tokens that their merge never reaches are left out, as
    no text yields them. A merge (a, b) is not reached if an earlier merge joins the end
    of a with the beginning of b, the leftmost of equal ones first. The mark of a word's end
    becomes the byte ``WORD_END``, joined before all else. None: a model of another kind.
    """
    vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
    if model["type"] != "BPE" or model["dropout"] or any(model[k] for k in ("continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    pairs = [(a, b) for a, b in pairs if a in vocab and b in vocab]
    made = [vocab.get(a + b) for a, b in pairs]
    byte = byte_of_character()
    base = [c + e for c in byte for e in {"", suffix}]
    if None in made or any(x >= y for x, y in zip(made, made[1:])) or any(c not in vocab for c in base):
        return None
    if made and max(vocab[c] for c in base) >= made[0] or any(max(vocab[a], vocab[b]) >= i for (a, b), i in zip(pairs, made)):
        return None
    rank = dict(zip(pairs, made))
    first, last, reached = {}, {}, set(base)

    def crossed(a: str, b: str, i: int) -> bool:
        """Whether an earlier merge joins a token that ends a with one that begins b, while both stand."""
        x, x_until = a, i
        while x:
            y, y_until = b, i
            while y:
                q = rank.get((x, y), i)
                if q < x_until and q <= y_until and q < i:
                    return True
                y, y_until = first.get(y), vocab[y]
            x, x_until = last.get(x), vocab[x]
        return False

    for (a, b), i in rank.items():
        if a in reached and b in reached and not crossed(a, b, i):
            reached.add(a + b)
            first[a + b], last[a + b] = a, b
    out = {}
    for token in reached:
        ends = bool(suffix) and token.endswith(suffix)
        body = bytes(byte[c] for c in (token[: -len(suffix)] if ends else token))
        if not suffix or WORD_END.encode() not in body:
            out[body + WORD_END.encode() * ends] = vocab[token]
    return out | ({WORD_END.encode(): len(vocab) + 1} if suffix else {})


@cache
def sure_characters() -> list[int]:
    """Characters that libraries read alike, whatever their version of Unicode.

    Those of scripts of the first plane whose category is the same in Unicode 3.2 and now; the
    capital sigma, which has two small forms, control characters and all else are not among them.
    """
    old = unicodedata.ucd_3_2_0.category
    scripts = [(0x20, 0x7E), (0xA0, 0x233), (0x300, 0x345), (0x386, 0x3A2), (0x3A4, 0x3CE), (0x400, 0x481), (0x5D0, 0x5EA)]
    scripts += [(0x621, 0x64A), (0x660, 0x669), (0x905, 0x939), (0xE01, 0xE3A), (0x1E00, 0x1EF9), (0x2010, 0x2027), (0x2030, 0x205E)]
    scripts += [(0x20A0, 0x20AF), (0x3001, 0x3020), (0x3041, 0x3094), (0x30A1, 0x30FE), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF5E)]
    return [c for a, b in scripts for c in range(a, b + 1) if old(chr(c)) == unicodedata.category(chr(c)) not in ("Cn", "Cf", "Cc")]


@cache
def unsure() -> str:
    return "[^\\t\\n\\r" + "".join(f"\\x{{{c:x}}}" for c in sure_characters()) + "]"


def long_run(text: str) -> bool:
    """Whether white space, or anything else, goes on for ``LONGEST_RUN`` characters: such a run fills one of the blocks of half that length."""
    half = LONGEST_RUN // 2
    blocks = range(0, len(text) - half + 1, half)
    return any(text.find(" ", i, i + half) < 0 or text[i : i + half].isspace() for i in blocks) and _RUN.search(text) is not None


class Plain:
    """Ids by tiktoken of texts that it surely reads as the tokenizers library does."""

    def __init__(self, spec: dict, table: dict[bytes, int], pattern: str | None):
        import tiktoken

        self.pattern = pattern  # of words, where they are marked; else tiktoken finds them itself
        cut = f"[^\\s{WORD_END}]+{WORD_END}" if pattern else spec["pattern"]
        self.ids = tiktoken.Encoding("plain", pat_str=cut, mergeable_ranks=table, special_tokens={}).encode_ordinary

    @classmethod
    def of(cls, spec: dict) -> Plain | None:
        """None for a tokenizer that is none of the two kinds known here."""
        import public_tokenizers

        table = ranks(spec["model"]) if spec["model"]["type"] == "BPE" else None
        if table is None:
            return None
        pre, normal = spec["pre_tokenizer"] or {}, spec["normalizer"]
        suffix = spec["model"]["end_of_word_suffix"]
        if pre.get("type") == "ByteLevel" and not normal and not suffix and pre["use_regex"] and not pre["add_prefix_space"]:
            return cls({"pattern": public_tokenizers.PATTERN}, table, None)
        steps = pre.get("pretokenizers", [])
        lowers = [(n["type"], n.get("pattern"), n.get("content")) for n in (normal or {}).get("normalizers", [])]
        if suffix and lowers == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]:
            if [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["invert"] and steps[0]["behavior"] == "Removed":
                if not steps[1]["use_regex"] and not steps[1]["add_prefix_space"] and "Regex" in steps[0]["pattern"]:
                    return cls({}, table, steps[0]["pattern"]["Regex"].replace(r"\s", r"\s\pZ"))
        return None

    def takes(self, texts: list[str]) -> list[bool]:
        """Only sure characters, and no run of white space or of other characters that would cost its square."""
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), unsure()).to_pylist()
        return [not o and not long_run(t) for o, t in zip(odd, texts)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.pattern:
            lowered = [t.lower() if t.isascii() else unicodedata.normalize("NFC", t).lower() for t in texts]
            marked = pc.replace_substring_regex(pa.array(lowered, pa.large_string()), self.pattern, "\\0" + WORD_END)
            texts = marked.to_pylist()
        return list(map(self.ids, texts))


class Encoder:
    """Ids as little-endian bytes, two for each id if the vocabulary allows, else four."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.spaced = (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel" and spec["normalizer"] is None
        self.special = [t["content"] for t in spec["added_tokens"]]
        top = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.kind, self.width = ("H", 2) if top < 1 << 16 else ("I", 4)
        self.known = Known(self._encode_pieces)
        self.plain = Plain.of(spec)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes | None]:
        ids = self._library(pieces)
        return [i if not self.spaced or spaced_alone(p) else None for p, i in zip(pieces, ids)]

    def _pieces(self, text: str) -> list[str] | None:
        if "\x00" in text or any(s in text for s in self.special):
            return None
        if self.spaced:
            return spaced_pieces(text)
        return None if _SEPARATORS.search(text) else bare_pieces(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.plain is None:
            return self._encode_cut(texts)
        plain = [p and not any(s in t for s in self.special) for t, p in zip(texts, self.plain.takes(texts))]
        fast = iter(self.plain.encode([t for t, p in zip(texts, plain) if p]))
        slow = iter(self._encode_cut([t for t, p in zip(texts, plain) if not p]))
        return [array(self.kind, next(fast)).tobytes() if p else next(slow) for p in plain]

    def _encode_cut(self, texts: list[str]) -> list[bytes]:
        cut = [self._pieces(t) if t else [] for t in texts]
        known = self.known.learn(set().union(*(c for c in cut if c)))
        out: list[bytes] = []
        whole: list[int] = []
        for i, pieces in enumerate(cut):
            try:
                out.append(b"".join(map(known.__getitem__, pieces)))
            except TypeError:  # not cut, or a piece that must not stand alone
                out.append(b"")
                whole.append(i)
        for i in whole:
            out[i] = self._library([texts[i]])[0]
        return out


_held: list[tuple[type, str, object]] = []


def held(kind: type, path: str):
    """The worker's one model: asked for another, it drops the one before with all it knows, so stages that follow each other do not add up."""
    if not _held or _held[0][:2] != (kind, path):
        _held.clear()
        release()
        _held.append((kind, path, kind(path)))
    return _held[0][2]


def encoder(path: str) -> Encoder:
    return held(Encoder, path)


@contextmanager
def for_task(kind: type, path: str) -> Iterator:
    """The worker's model for one task: what it learned goes when the task ends, also in failure, so a reused worker does not carry it into later stages."""
    model = held(kind, path)
    try:
        yield model
    finally:
        model.known.forget()
        release()


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
