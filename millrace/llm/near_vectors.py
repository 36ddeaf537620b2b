"""Near-equal vectors: sign hashes of random hyperplanes in several tables, exact cosines, connected components.

Equal vectors are one class first. Two classes meet in a table if all their signs agree there; the first
table in which they meet counts the pair, so nothing is counted twice and no pair is ever written: a bucket
returns, for each class, how many vectors it is linked with and the smallest class of its part of the bucket's
spanning forest. A bucket with very many classes is cut into blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import batch
from millrace.llm.components import components
from millrace.operators.joins import checked_broadcast
from millrace.session import stored

BUCKET = 256  # classes that share a bucket by chance, on average
BLOCK = 8192  # classes of one bucket that a task takes from either side
TILE = 512
MAX_BITS = 30


def tables_needed(cosine: float, bits: int, recall: float) -> int:
    """Tables after which a pair at the threshold has met with probability ``recall``."""
    met = (1 - math.acos(cosine) / math.pi) ** bits
    return 1 if met >= recall else math.ceil(math.log(1 - recall) / math.log1p(-met))


def bits_for(classes: int, bucket: int) -> int:
    """Signs a table: chance buckets keep their size, whatever the number of classes."""
    return min(MAX_BITS, max(0, math.ceil(math.log2(max(1, classes) / bucket))))


def scaled(values: np.ndarray) -> np.ndarray:
    """Rows as doubles times a power of two that brings the largest component near one: cosines stay as they are, squares cannot overflow or vanish."""
    values = values.astype(np.float64)
    _, exponent = np.frexp(np.abs(values).max(axis=1))
    return np.ldexp(values, -exponent[:, None])


def _codes(bits: int, tables: int, seed: int):
    """Adds a vector's signs, ``bits`` of them for each table; a vector's length is part of every code's hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(0, dtype=np.int64)
        for rows in batches:
            vectors = rows.column("embedding")
            out = np.zeros((rows.num_rows, tables), dtype=np.int32)
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                if dim not in planes:
                    planes[dim] = np.random.RandomState([seed, dim]).standard_normal((dim, bits * tables))
                at = np.flatnonzero(sizes == dim)
                x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                signs = (scaled(x) @ planes[dim] > 0).reshape(len(at), tables, bits)
                out[at] = (signs * weights).sum(axis=2)
            offsets = pa.array(np.arange(rows.num_rows + 1, dtype=np.int32) * tables)
            codes = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            schema = pa.schema([*[rows.schema.field(i) for i in range(3)], ("codes", codes.type)])
            yield pa.RecordBatch.from_arrays([*[rows.column(i) for i in range(3)], codes], schema=schema)

    return run


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


class Forest:
    """Joins the ends of links given as a matrix of flags, a few unions at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def labels(self) -> np.ndarray:
        parent = self.parent
        while True:
            up = parent[parent]
            if (up == parent).all():
                self.parent = parent
                return parent
            parent = up

    def link(self, mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Every left[i] and right[j] with mask[i, j] end in one tree."""
        while True:
            label = self.labels()
            open_ = mask & (label[left][:, None] != label[right][None, :])
            rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                return
            for ends in (zip(left[rows], right[open_[rows].argmax(axis=1)]), zip(left[open_[:, cols].argmax(axis=0)], right[cols])):
                for a, b in ends:
                    a, b = _root(self.parent, a), _root(self.parent, b)
                    if a != b:
                        self.parent[max(a, b)] = min(a, b)


def compare(vectors: np.ndarray, codes: np.ndarray, members: np.ndarray, split: int, within: bool, table: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of the first ``split`` rows with the others, or of all rows with each other if ``within``.

    Only pairs whose codes differ in every table before ``table`` count. For each row: members it is linked with, and
    the first row of its tree.
    """
    n = len(vectors)
    x = scaled(vectors)
    norm = np.sqrt((x * x).sum(axis=1))
    links, forest = np.zeros(n), Forest(n)
    left, right = (np.arange(n), np.arange(n)) if within else (np.arange(split), np.arange(split, n))
    for at in range(0, len(left), TILE):
        rows = left[at : at + TILE]
        cols = right[right > rows[0]] if within else right
        if not len(cols):
            continue
        mask = (x[rows] @ x[cols].T) / (norm[rows][:, None] * norm[cols][None, :]) >= cosine
        if within:
            mask &= rows[:, None] < cols[None, :]
        some, other = mask.any(axis=1), mask.any(axis=0)
        if not some.any():
            continue
        rows, cols, mask = rows[some], cols[other], mask[np.ix_(some, other)]
        for before in range(table):
            mask &= codes[rows, before][:, None] != codes[cols, before][None, :]
        links[rows] += mask @ members[cols]
        links[cols] += members[rows] @ mask
        forest.link(mask, rows, cols)
    return links.astype(np.int64), forest.labels()


_FOUND = "class long, links long, root long"
_FOUND_ARROW = pa.schema([("class", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
_KEY = ["dim", "table", "code", "lo", "hi"]


def _buckets(cosine: float):
    """Rows come in the order of their bucket and block; one group is in memory at a time."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        dim, table, lo, hi = (rows.column(c)[0].as_py() for c in ("dim", "table", "lo", "hi"))
        rows = rows.combine_chunks()
        block, ids = (rows.column(c).to_numpy() for c in ("block", "class"))
        order = np.lexsort((ids, block))
        vectors = rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)[order]
        codes = rows.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)[order]
        members = rows.column("members").to_numpy()[order].astype(np.float64)
        ids, split = ids[order], int((block == lo).sum())
        links, tree = compare(vectors, codes, members, split, lo == hi, table, cosine)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, tree, ids)
        some = links > 0
        return batch({"class": ids[some], "links": links[some], "root": least[tree][some]}, _FOUND_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for rows in batches:
            if not rows.num_rows:
                continue
            keys = np.stack([rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in _KEY], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), rows.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                key = tuple(keys[start])
                if held and key != last:
                    yield found(pa.Table.from_batches(held))
                    held = []
                held.append(rows.slice(start, stop - start))
                last = key
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _in_blocks(coded: DataFrame, block: int) -> DataFrame:
    """A row for each table and each meeting of two blocks; buckets of up to ``block`` classes have one block and one meeting."""
    each = coded.select("class", "members", "embedding", "codes", F.size("embedding").alias("dim"), F.posexplode("codes").alias("table", "code"))
    sizes = coded.select(F.size("embedding").alias("dim"), F.posexplode("codes").alias("table", "code")).groupBy("dim", "table", "code").count()
    # buckets over the block size: at most one for every `block` rows
    large = stored(sizes.where(F.col("count") > block).select("dim", "table", "code", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "large-buckets")
    cut = each.join(checked_broadcast(large), ["dim", "table", "code"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = cut.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    met = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("class", "members", "embedding", "codes", "block", "dim", "table", "code", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def near_vectors(vectors: DataFrame, cosine: float = 0.9, recall: float = 0.9999, bucket: int = BUCKET, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """Links between vectors with a cosine of ``cosine`` or more, as counts and components.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored, whatever their names. One row a vector:
    vec_id, n_links (vectors linked directly, equal ones included), component_id (smallest id reachable),
    kept (vec_id is that id). Vectors that are null, empty, zero, without an id, or hold null or non-finite
    components link with nothing: they are their own component. Vectors of different lengths do not link.
    Repeated rows are vectors of their own and link with each other. An empty table gives no row.

    A pair just at the threshold is found with probability ``recall`` and a closer one more surely; none below the
    threshold links. The number of tables follows from it, that of signs from the number of classes.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # floats move as floats; all arithmetic is in doubles
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    judged = rows.select("vec_id", "embedding", F.coalesce(sound, F.lit(False)).alias("sound"))
    keyed = judged.where("sound").select("vec_id", "embedding", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(seed), "embedding").alias("k2"))
    equal = keyed.groupBy("k1", "k2").agg(F.min("vec_id").alias("least"), F.count("*").alias("members"), F.first("embedding").alias("embedding"))
    classes = stored(equal.withColumn("class", F.monotonically_increasing_id()), "vector-classes")  # numbers hold once written
    many = classes.count()
    bits = bits_for(many, bucket)
    tables = tables_needed(cosine, bits, recall)
    coded = stored(classes.select("class", "members", "embedding").mapInArrow(_codes(bits, tables, seed), f"class long, members long, embedding {kind}, codes array<int>"), "vector-codes")
    grouped = _in_blocks(coded, block).repartition(*_KEY).sortWithinPartitions(*_KEY)
    found = stored(grouped.mapInArrow(_buckets(cosine), _FOUND), "vector-links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    rooted = classes.select("k1", "k2", "class", "members", "least").join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "class")).join(links, "class", "left")
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = rooted.join(heads, "root").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), "component_id")
    # classes of equal vectors can be hot: adaptive execution splits the left side
    linked = keyed.select("vec_id", "k1", "k2").join(facts, ["k1", "k2"], "left").select("vec_id", "n_links", "component_id")
    alone = judged.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
