"""Benchmark items in documents within an edit budget, by the pigeonhole principle.

An item with a budget of e edits is split into e + 1 pieces. Where it occurs within the
budget, one piece at least occurs as it is. All pieces of all items are looked for in one
pass over each document; around every hit the item is verified with Myers' bit-parallel distance.

Items reach the tasks in blocks of bounded size. More items mean more passes, not larger tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices, texts
from millrace.operators.joins import checked_broadcast
from millrace.session import stored

ITEM_BYTES = 16 << 20
_MARKS = b".,;:!?\"'()[]"


@dataclass(frozen=True)
class Budget:
    """Edits allowed as a share of an item's length; items under ``least`` bytes count only as they are, as whole words."""

    share: float = 0.05
    least: int = 24


def plain(text: str) -> str:
    """Lower case, no common punctuation, single spaces; each character stands for one UTF-8 byte."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(None, _MARKS).split()
    return b" ".join(words).decode("latin-1")


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces of like length and where they begin."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]


def best_distance(item: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any stretch of ``text`` and where that ends; Myers' algorithm with one bit for each character."""
    masks = masks if masks is not None else bit_masks(item)
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, distance = full, 0, size
    best, at = size, 0
    for i, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & top:
            distance += 1
        elif mh & top:
            distance -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | ~(xv | ph) & full
        minus = ph & xv
        if distance < best:
            best, at = distance, i
    return best, at


def bit_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class ItemIndex:
    """The pieces of some items in one automaton."""

    def __init__(self, items: list[tuple[object, str]], budget: Budget):
        import ahocorasick

        self.items = [(key, text, int(len(text) * budget.share) if len(text) >= budget.least else 0) for key, text in items if text]
        self.least = budget.least
        self.masks: dict[int, dict[str, int]] = {}
        of_piece: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, edits) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                of_piece.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in of_piece.items():
            self.automaton.add_word(piece, (len(piece), places))
        if of_piece:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """By item number: smallest distance within its budget, and where that occurrence ends."""
        found: dict[int, tuple[int, int]] = {}
        tried: dict[int, int] = {}
        if not self.items:
            return found
        for end, (size, places) in self.automaton.iter(text):
            for n, at in places:
                if found.get(n, (1, 0))[0] == 0:
                    continue
                _, item, edits = self.items[n]
                start = end + 1 - size - at
                if len(item) < self.least and (start > 0 and text[start - 1] != " " or text[end + 1 : end + 2] not in ("", " ")):
                    continue
                if start >= 0 and text.startswith(item, start):
                    found[n] = (0, start + len(item))
                    continue
                if edits == 0 or tried.get(n) == start:  # this window was just looked at
                    continue
                tried[n] = start
                begin = max(0, start - edits)
                if n not in self.masks:
                    self.masks[n] = bit_masks(item)
                distance, stop = best_distance(item, text[begin : start + len(item) + edits], self.masks[n])
                if distance <= edits and distance < found.get(n, (edits + 1, 0))[0]:
                    found[n] = (distance, begin + stop)
        return found


_built: list[tuple[object, ItemIndex]] = []


def _index(items: list[tuple[object, str]], budget: Budget) -> ItemIndex:
    """The index of this block of items, built once in a worker: the worker keeps a broadcast value."""
    if not _built or _built[0][0] is not items:
        _built[:] = [(items, ItemIndex(items, budget))]
    return _built[0][1]


def item_rows(items: DataFrame) -> DataFrame:
    """item_id, key, text of the items, stored; equal texts have one key."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    return stored(rows.select("item_id", F.sha2("text", 256).alias("key"), "text"), "items")


def item_blocks(rows: DataFrame, block_bytes: int = ITEM_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Key and text of the different items, in blocks of about ``block_bytes``; no block is larger than twice that but for a single larger item."""
    each = stored(rows.select("key", "text").dropDuplicates(["key"]), "item-texts")
    total = each.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = -(-total // block_bytes)
    for block in range(many):
        part = each.where(F.pmod(F.xxhash64("text"), F.lit(many)) == block)
        yield [(r.key, plain(r.text)) for r in part.collect()]


_HITS = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("distance", pa.int64()), ("end_byte", pa.int64())])


def contaminated(docs: DataFrame, items: DataFrame, budget: Budget = Budget(), block_bytes: int = ITEM_BYTES) -> DataFrame:
    """Documents that hold a benchmark item within the edit budget.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``. Per document and item: doc_id,
    item_id, distance (the smallest found), end_byte (where that occurrence ends in the text as ``plain`` leaves it).
    Null and empty texts match nothing; ids may be null; equal items match each for itself. No shuffle of documents.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    ddl = "doc_id long, key string, distance long, end_byte long"
    out = docs.sparkSession.createDataFrame([], ddl)
    known = item_rows(items)
    for block in item_blocks(known, block_bytes):
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent.value, budget)
            for part in slices(batches):
                hits: dict[str, list] = {f.name: [] for f in _HITS}
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts(part)):
                    for n, (distance, end) in index.find(plain(text)).items():
                        for column, value in zip(hits.values(), (doc_id, index.items[n][0], distance, end)):
                            column.append(value)
                yield batch(hits, _HITS)

        out = out.unionByName(rows.mapInArrow(run, ddl))
    ids = checked_broadcast(known.select("item_id", F.col("key").alias("_key")))
    return out.join(ids, F.col("key") == F.col("_key")).select("doc_id", "item_id", "distance", "end_byte")


def drop_contaminated(docs: DataFrame, items: DataFrame, budget: Budget = Budget(), block_bytes: int = ITEM_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns and other rows as they were."""
    context = docs.sparkSession.sparkContext
    for block in item_blocks(item_rows(items), block_bytes):
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent.value, budget)
            for part in slices(batches):
                clean = np.array([not index.find(plain(t)) for t in texts(part)])
                yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
