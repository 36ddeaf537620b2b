"""Concatenate all documents and cut them into sequences of one length.

Pass one encodes each text, stores the ids, and knows its place among the ids of
its partition. The partition totals, summed up, give every partition its place in
the whole; pass two reads the stored ids and cuts at the multiples of the length.
A document cut in two leaves a record on either side of the boundary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices, texts
from millrace.llm.encode import Encoder, for_task
from millrace.session import stored

SLICE = 1 << 20
_ENCODED = "doc_id long, part int, part_start long, doc_tokens long, ids binary, width int"
_ENCODED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("width", pa.int32())]
)
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in _PIECES.split(", ")])


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Stored ids of every text and their place within the partition that encoded them."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        with for_task(Encoder, tokenizer) as enc:
            end = end_id.to_bytes(enc.width, "little")
            for rows in slices(batches, limit=SLICE):
                ids = [i + end for i in enc.encode(texts(rows))]
                sizes = np.array([len(i) // enc.width for i in ids], dtype=np.int64)
                starts = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                n = len(ids)
                yield batch(
                    {
                        "doc_id": rows.column("doc_id"),
                        "part": np.full(n, part, np.int32),
                        "part_start": starts,
                        "doc_tokens": sizes,
                        "ids": ids,
                        "width": np.full(n, enc.width, np.int32),
                    },
                    _ENCODED_ARROW,
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(encode, _ENCODED), "ids")


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` ids.

    ``docs`` needs ``doc_id`` and ``text``; a null text is empty and still has its end
    id, a null id stays null, repeated rows are packed as often as they come. Only the last sequence is
    shorter than ``length``. One row for each piece: doc_id, start (ids of the document before it), length,
    ids_crc32 (its ids as four bytes each), doc_tokens, sequence_id, offset in the sequence.
    An empty table gives no row.
    """
    ids = encoded(docs, tokenizer, end_id)
    totals = ids.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("part_offset"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "ids"):
            out: dict[str, list[int | None]] = {f.name: [] for f in _PIECES_ARROW}
            for doc_id, part_start, n, data, width, offset in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "part_start", "doc_tokens", "ids", "width", "part_offset"))):
                wide = np.frombuffer(data, f"<u{width}").astype("<u4")
                begin = part_start + offset
                at = 0
                while at < n:
                    place = begin + at
                    size = min(n - at, length - place % length)
                    values = (doc_id, at, size, zlib.crc32(wide[at : at + size]), n, place // length, place % length)
                    for column, value in zip(out.values(), values):
                        column.append(value)
                    at += size
            yield batch(out, _PIECES_ARROW)

    # one row for each partition of the pass before: at most as many as Spark has tasks in a stage
    return ids.join(F.broadcast(offsets), "part").select("doc_id", "part_start", "doc_tokens", "ids", "width", "part_offset").mapInArrow(cut, _PIECES)
