"""Ranked lexical search by MaxScore whose bounds hold for pairs of terms.

The documents are cut into parts, each with an index of its own: postings of the searched terms with their impacts
(scores of one term in one document), the largest impact of each term, and for the strongest terms of
an item the lists of documents that hold two of them, with the largest joint impact. A document
scores at most the sum of its terms' maxima; two terms that are strong in different documents are bounded
by what they reach together, which is often little over the larger of the two. Disjoint pairs are chosen to save
most. Units (pairs or single terms) whose bounds together stay below the tenth score so far cannot bring a new
document in; the others are walked from the strongest on, and a document is left as soon as its bound is below.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices, texts
from millrace.session import stored

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEM_BYTES = 16 << 20  # item texts of a block; each block is a pass over the documents
PART_BYTES = 16 << 20  # text of an index part
STRONG = 8  # terms of an item whose pairs are kept: at most 28 lists an item and part


def terms(text: str) -> list[str]:
    return TERM.findall(text.encode().lower().decode())  # of bytes, lower() changes A-Z only


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Statistics:
    """Of the whole corpus, for one block of items."""

    documents: int
    length: int
    weights: dict[str, int]


_PART = "documents long, length long, ids array<long>, sizes array<long>, terms array<string>, starts array<int>, ords binary, tfs binary"
_PART_ARROW = pa.schema(
    [
        ("documents", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.string())),
        ("starts", pa.list_(pa.int32())),
        ("ords", pa.binary()),
        ("tfs", pa.binary()),
    ]
)


class PartBuilder:
    """Postings of one part, of the wanted terms only (all, if None); lengths count every term."""

    def __init__(self, wanted: frozenset[str] | None):
        self.wanted = wanted
        self.clear()

    def clear(self) -> None:
        self.bytes = self.documents = self.length = 0
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.postings: dict[str, tuple[list[int], list[int]]] = {}

    def add(self, doc_id: int | None, text: str) -> None:
        self.bytes += len(text)
        found = terms(text)
        if not found:
            return
        self.documents += 1
        self.length += len(found)
        held = found if self.wanted is None else filter(self.wanted.__contains__, found)
        counts = Counter(held)
        if not counts:
            return
        ordinal = len(self.ids)
        self.ids.append(doc_id)
        self.sizes.append(len(found))
        for term, tf in counts.items():
            ords, tfs = self.postings.setdefault(term, ([], []))
            ords.append(ordinal)
            tfs.append(tf)

    def row(self) -> pa.RecordBatch:
        order = sorted(self.postings)
        starts = np.cumsum([0, *(len(self.postings[t][0]) for t in order)])
        columns = [np.fromiter(itertools.chain.from_iterable(self.postings[t][i] for t in order), dtype=np.uint32, count=int(starts[-1])).tobytes() for i in (0, 1)]
        row = (self.documents, self.length, self.ids, self.sizes, order, starts.tolist(), *columns)
        out = batch({name: [value] for name, value in zip(_PART_ARROW.names, row)}, _PART_ARROW)
        self.clear()
        return out


def index_parts(docs: DataFrame, wanted: frozenset[str] | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each part of the documents, with its postings; no shuffle. Documents without a term count for nothing."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(wanted)  # at most the terms of ITEM_BYTES of item texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = PartBuilder(sent.value)
        for rows in slices(batches):
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts(rows)):
                part.add(doc_id, text)
                if part.bytes >= part_bytes:
                    yield part.row()
        if part.bytes or part.documents:
            yield part.row()

    return stored(rows.mapInArrow(run, _PART), "index")


def statistics(parts: DataFrame, wanted: frozenset[str]) -> Statistics:
    """Corpus sizes and the weight of each wanted term; that many numbers reach the driver."""
    total = parts.agg(F.sum("documents").alias("n"), F.sum("length").alias("l")).first()
    each = parts.select("starts", F.posexplode("terms").alias("i", "term"))
    df = each.select("term", (F.element_at("starts", F.col("i") + 2) - F.element_at("starts", F.col("i") + 1)).alias("df"))
    names = parts.sparkSession.createDataFrame([(t,) for t in sorted(wanted)], "term string")  # at most the terms of ITEM_BYTES of text
    counts = df.join(F.broadcast(names), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()
    n = total.n or 0
    return Statistics(n, total.l or 0, {r.term: weight(n, r.df) for r in counts})


_IMPACTS = "ids array<long>, terms array<string>, starts array<int>, most array<long>, ords binary, impacts binary, left array<int>, right array<int>, joint array<long>, joint_starts array<int>, joint_ords binary"
_IMPACTS_ARROW = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.string())),
        ("starts", pa.list_(pa.int32())),
        ("most", pa.list_(pa.int64())),
        ("ords", pa.binary()),
        ("impacts", pa.binary()),
        ("left", pa.list_(pa.int32())),
        ("right", pa.list_(pa.int32())),
        ("joint", pa.list_(pa.int64())),
        ("joint_starts", pa.list_(pa.int32())),
        ("joint_ords", pa.binary()),
    ]
)


def impact(w: int, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def with_impacts(row: dict, known: Statistics, items: list[list[str]]) -> dict:
    """The part's impacts and, for pairs of each item's strongest terms here, their common documents and the largest joint impact."""
    ords, tfs = (np.frombuffer(row[c], dtype=np.uint32).astype(np.int64) for c in ("ords", "tfs"))
    sizes = np.array(row["sizes"], dtype=np.int64)
    m = 10 + (90 * sizes * known.documents) // known.length
    at = {t: i for i, t in enumerate(row["terms"]) if t in known.weights}
    starts = row["starts"]
    out_ords, out_impacts = [], []
    for t, i in at.items():
        mine = ords[starts[i] : starts[i + 1]]
        out_ords.append(mine)
        out_impacts.append(impact(known.weights[t], tfs[starts[i] : starts[i + 1]], m[mine]))
    number = {t: i for i, t in enumerate(at)}
    most = [int(x.max()) for x in out_impacts]
    pairs: set[tuple[int, int]] = set()
    for item in items:
        strong = sorted((number[t] for t in item if t in number), key=lambda i: (-most[i], i))[:STRONG]
        pairs.update((a, b) if a < b else (b, a) for a, b in itertools.combinations(strong, 2))
    left, right, joint, common_ords = [], [], [], []
    for a, b in sorted(pairs):
        common, x, y = np.intersect1d(out_ords[a], out_ords[b], assume_unique=True, return_indices=True)
        left.append(a)
        right.append(b)
        common_ords.append(common)
        joint.append(int((out_impacts[a][x] + out_impacts[b][y]).max()) if len(common) else 0)
    join = lambda parts, kind: np.concatenate([np.zeros(0, np.int64), *parts]).astype(kind).tobytes()
    return {
        "ids": row["ids"],
        "terms": list(at),
        "starts": np.cumsum([0, *map(len, out_ords)]).tolist(),
        "most": most,
        "ords": join(out_ords, np.uint32),
        "impacts": join(out_impacts, np.int64),
        "left": left,
        "right": right,
        "joint": joint,
        "joint_starts": np.cumsum([0, *map(len, common_ords)]).tolist(),
        "joint_ords": join(common_ords, np.uint32),
    }


@dataclass
class Part:
    """An index part in memory: what ``with_impacts`` has stored."""

    ids: list[int | None]
    number: dict[str, int]
    ords: list[np.ndarray]
    impacts: list[np.ndarray]
    most: list[int]
    joint: dict[tuple[int, int], tuple[int, np.ndarray]]

    @classmethod
    def of(cls, row: dict) -> Part:
        def cut(data: bytes, kind: type, starts: list[int]) -> list[np.ndarray]:
            values = np.frombuffer(data, dtype=kind).astype(np.int64)
            return [values[a:b] for a, b in itertools.pairwise(starts)]

        common = cut(row["joint_ords"], np.uint32, row["joint_starts"])
        pairs = zip(row["left"], row["right"], row["joint"], common)
        return cls(
            row["ids"],
            {t: i for i, t in enumerate(row["terms"])},
            cut(row["ords"], np.uint32, row["starts"]),
            cut(row["impacts"], np.int64, row["starts"]),
            row["most"],
            {(a, b): (top, ords) for a, b, top, ords in pairs},
        )


def units(part: Part, wanted: list[int], paired: bool = True) -> list[tuple[int, tuple[int, ...]]]:
    """Disjoint pairs that lower the sum of bounds most, then single terms: (bound, terms), the largest bound first.

    A document with one term of a pair only is bounded by that term's maximum.
    """
    savings = []
    for a, b in itertools.combinations(sorted(wanted), 2) if paired else ():
        if (a, b) in part.joint:
            bound = max(part.joint[a, b][0], part.most[a], part.most[b])
            savings.append((part.most[a] + part.most[b] - bound, a, b, bound))
    out, used = [], set()
    for saving, a, b, bound in sorted(savings, key=lambda s: (-s[0], s[1:3])):
        if saving > 0 and a not in used and b not in used:
            used |= {a, b}
            out.append((bound, (a, b)))
    out += [(part.most[t], (t,)) for t in wanted if t not in used]
    return sorted(out, key=lambda u: (-u[0], u[1]))


class Best:
    """The k best of an item so far: highest score first, then the smaller id, a null id last."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 1

    def add(self, ids: list[int | None], scores: np.ndarray) -> None:
        rows = [*self.rows, *((-int(s), i is None, i or 0, i) for i, s in zip(ids, scores.tolist()) if s > 0)]
        self.rows = sorted(rows, key=lambda r: r[:3])[: self.k]
        if len(self.rows) == self.k:
            self.floor = -self.rows[-1][0]


def search_part(part: Part, item: list[str], best: Best, paired: bool = True) -> int:
    """Add this part's documents to ``best``; returns how many documents it looked at.

    A document is passed over only if its bound is below the k-th score: an equal score may still win by its id.
    """
    order = units(part, [part.number[t] for t in item if t in part.number], paired)
    rest = [0]
    for bound, _ in reversed(order):
        rest.append(rest[-1] + bound)
    rest.reverse()  # rest[i]: what units i, i + 1, ... can give together
    seen = np.zeros(len(part.ids), dtype=bool)

    def finish(ords: np.ndarray, scores: np.ndarray, after: int) -> None:
        for j in range(after, len(order)):
            stay = scores + rest[j] >= best.floor
            if not stay.all():
                ords, scores = ords[stay], scores[stay]
            if not len(ords):
                return
            for t in order[j][1]:
                at = np.searchsorted(part.ords[t], ords)
                at[at == len(part.ords[t])] = 0
                scores = scores + np.where(part.ords[t][at] == ords, part.impacts[t][at], 0)
        top = scores >= best.floor
        best.add([part.ids[o] for o in ords[top].tolist()], scores[top])

    for i, (_, members) in enumerate(order):
        if rest[i] < best.floor:
            break
        if len(members) == 1:
            ords, scores = part.ords[members[0]], part.impacts[members[0]]
        else:
            both = np.concatenate([part.ords[t] for t in members])
            ords, place = np.unique(both, return_inverse=True)
            scores = np.zeros(len(ords), dtype=np.int64)
            np.add.at(scores, place, np.concatenate([part.impacts[t] for t in members]))
        new = ~seen[ords]
        seen[ords] = True
        ords, scores = ords[new], scores[new]
        if len(members) == 2 and not best.rows:
            # the list of a pair's common documents gives a first k-th score
            common = part.joint[members][1]
            first = np.isin(ords, common, assume_unique=True)
            finish(ords[first], scores[first], i + 1)
            ords, scores = ords[~first], scores[~first]
        if len(ords) > 8 * best.k:
            first = np.zeros(len(ords), dtype=bool)
            first[np.argpartition(-scores, 4 * best.k)[: 4 * best.k]] = True
            finish(ords[first], scores[first], i + 1)
            ords, scores = ords[~first], scores[~first]
        finish(ords, scores, i + 1)
    return int(seen.sum())


_HITS = "item long, doc_id long, score long"
_HITS_ARROW = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def item_blocks(items: DataFrame, block_bytes: int = ITEM_BYTES) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Ids and different terms of the items, in blocks of about ``block_bytes`` of text; rows of one id are one item."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    rows = stored(rows, "search-items")
    many = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    for block in range(many):
        found: dict[int | None, dict[str, None]] = {}
        for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(many)) == block).collect():
            found.setdefault(r.item_id, {}).update(dict.fromkeys(terms(r.text)))
        yield [(i, list(t)) for i, t in found.items()]


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = ITEM_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """Each item's ``k`` best documents.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` needs ``item_id`` and ``text``; other columns are ignored, whatever their
    names. Columns: item_id, rank (from 1), doc_id, score. Equal scores rank by ascending doc_id, a null one last;
    only scores above 0 count. Null and empty texts hold no term: such documents are not counted and such items
    have no rows. Rows of one item_id are one item with the terms of all; repeated documents are documents of their own.

    One pass over the documents builds the index, one over the index its impacts and pair lists, one searches them.
    Each task returns its ``k`` best for each item. Items of more than ``block_bytes`` go in blocks, over one index of all terms.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    blocks = list(itertools.islice(item_blocks(items, block_bytes), 2))
    if not blocks:
        return out
    vocabulary = frozenset(t for _, each in blocks[0] for t in each)
    parts = index_parts(docs, vocabulary if len(blocks) == 1 else None, part_bytes)
    for block in blocks if len(blocks) == 1 else item_blocks(items, block_bytes):
        out = out.unionByName(_ranked_block(parts, block, k))
    return out


def _ranked_block(parts: DataFrame, block: list[tuple[int | None, list[str]]], k: int) -> DataFrame:
    context = parts.sparkSession.sparkContext
    known = statistics(parts, frozenset(t for _, each in block for t in each))
    sent = context.broadcast((known, [each for _, each in block]))  # at most ITEM_BYTES of item texts

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics, items = sent.value
        for rows in batches:
            for i in range(rows.num_rows):
                row = rows.slice(i, 1).to_pylist()[0]
                if row["ids"]:
                    out = with_impacts(row, statistics, items)
                    yield batch({name: [value] for name, value in out.items()}, _IMPACTS_ARROW)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, items = sent.value
        best = [Best(k) for _ in items]
        for rows in batches:
            for i in range(rows.num_rows):
                part = Part.of(rows.slice(i, 1).to_pylist()[0])
                for item, mine in zip(items, best):
                    search_part(part, item, mine)
        hits = [(n, r[3], -r[0]) for n, mine in enumerate(best) for r in mine.rows]
        yield batch(dict(zip(_HITS_ARROW.names, zip(*hits))) if hits else {n: [] for n in _HITS_ARROW.names}, _HITS_ARROW)

    ready = stored(parts.select(*_PART_ARROW.names).mapInArrow(prepare, _IMPACTS), "impacts")
    hits = ready.mapInArrow(search, _HITS)
    # tasks keep k rows an item before the shuffle as well
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = parts.sparkSession.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item long, item_id long")
    return top.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
