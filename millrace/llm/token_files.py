"""Token ids in binary files, with Elias-Fano coded document boundaries.

A file holds the documents of one range of ids, in ascending order::

    ids of all documents, two or four bytes each, little-endian, without gaps
    Elias-Fano code of the n + 1 boundaries in that array
    Elias-Fano code of the n document ids, less the first; null ids come first
    footer of fixed size

A boundary costs about two bits and the logarithm of the mean document length. The
k-th boundary is read with ``select``: a sample of positions, then a count of bits.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.batches import batch, slices, texts
from millrace.llm.encode import encoder
from millrace.session import shared_path, stored

SAMPLE = 256
_EF = struct.Struct("<QQBQQ")
_FOOTER = struct.Struct("<4sBQQQqQQ")
_MAGIC = b"MTI1"

MANIFEST = pa.schema(
    [
        ("file", pa.string()),
        ("first_doc_id", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_ids", pa.int64()),
        ("n_bytes", pa.int64()),
        ("boundary_bytes", pa.int64()),
    ]
)
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


@dataclass
class EliasFano:
    """A rising sequence of whole numbers, coded; ``low_bits`` of each stand apart."""

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros((n, low_bits), dtype=np.uint8)
        for b in range(low_bits):
            low[:, b] = (values >> np.uint64(b)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        pack = lambda bits: np.packbits(bits.ravel(), bitorder="little")
        return cls(n, low_bits, pack(low), pack(high), ones[::SAMPLE].astype("<u4"))

    def select(self, k: int) -> int:
        """Value ``k``, from the nearest sample on."""
        at, left = int(self.samples[k // SAMPLE]), k % SAMPLE
        byte, skip = at // 8, at % 8
        left += 1
        while True:
            bits = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
            bits[:skip] = 0
            found = int(bits.sum())
            if found >= left:
                one = byte * 8 + int(np.flatnonzero(bits)[left - 1])
                break
            left, byte, skip = left - found, byte + 64, 0
        first = k * self.low_bits
        bits = np.unpackbits(self.low[first // 8 : (first + self.low_bits + 7) // 8], bitorder="little")
        low = int(sum(int(b) << i for i, b in enumerate(bits[first % 8 : first % 8 + self.low_bits])))
        return (one - k) << self.low_bits | low

    def range(self, start: int, stop: int) -> np.ndarray:
        """Values ``start`` to ``stop``, the last one excluded."""
        if stop <= start:
            return np.zeros(0, dtype=np.int64)
        a = start - start % SAMPLE
        begin = int(self.samples[a // SAMPLE]) // 8
        after = (stop + SAMPLE - 1) // SAMPLE
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        bits = np.unpackbits(self.high[begin:end], bitorder="little")
        bits[: int(self.samples[a // SAMPLE]) - begin * 8] = 0
        ones = np.flatnonzero(bits)[start - a : stop - a] + begin * 8
        out = (ones - np.arange(start, stop)) << self.low_bits
        first = start * self.low_bits
        low = np.unpackbits(self.low[first // 8 : (stop * self.low_bits + 7) // 8], bitorder="little")
        low = low[first % 8 : first % 8 + (stop - start) * self.low_bits].reshape(stop - start, self.low_bits)
        for b in range(self.low_bits):
            out += low[:, b].astype(np.int64) << b
        return out

    def dump(self) -> bytes:
        head = _EF.pack(self.n, len(self.samples), self.low_bits, len(self.low), len(self.high))
        return head + self.samples.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def load(cls, data: bytes) -> EliasFano:
        n, samples, low_bits, low, high = _EF.unpack_from(data)
        at = _EF.size
        parts = [np.frombuffer(data, "<u4", samples, at)]
        at += samples * 4
        for size in (low, high):
            parts.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        return cls(n, low_bits, parts[1], parts[2], parts[0])


class TokenWriter:
    """Appends documents to a binary file object; ``close`` writes the boundaries and the footer."""

    def __init__(self, out: io.RawIOBase, width: int):
        self.out, self.width = out, width
        self.ends, self.ids = [0], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.ends.append(self.ends[-1] + len(ids) // self.width)
        self.ids.append(doc_id)

    def close(self) -> tuple[int, int]:
        """Bytes of the file and of its boundaries."""
        nulls = sum(i is None for i in self.ids)
        known = np.array([i for i in self.ids if i is not None], dtype=np.int64)
        base = int(known[0]) if len(known) else 0
        boundaries, names = EliasFano.of(np.array(self.ends)).dump(), EliasFano.of((known - base).astype(np.uint64)).dump()
        body = self.ends[-1] * self.width
        self.out.write(boundaries)
        self.out.write(names)
        self.out.write(_FOOTER.pack(_MAGIC, self.width, len(self.ids), nulls, self.ends[-1], base, len(boundaries), len(names)))
        self.out.close()
        return body + len(boundaries) + len(names) + _FOOTER.size, len(boundaries)


class TokenReader:
    """Reads one file; documents are numbered from 0 in file order."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        footer = source.read_at(_FOOTER.size, size - _FOOTER.size)
        magic, self.width, self.n_docs, self.nulls, self.n_ids, self.base, a, b = _FOOTER.unpack(footer)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        at = self.n_ids * self.width
        self.boundaries = EliasFano.load(source.read_at(a, at))
        self.names = EliasFano.load(source.read_at(b, at + a))

    def start(self, k: int) -> int:
        return self.boundaries.select(k)

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        a, b = max(0, start - self.nulls), max(0, stop - self.nulls)
        return [None] * ((stop - start) - (b - a)) + [self.base + int(x) for x in self.names.range(a, b)]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids at these places of the concatenated array."""
        data = self.source.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(data, f"<u{self.width}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of every text in ascending ``doc_id`` order; returns the stored list of files.

    ``docs`` needs ``doc_id`` and ``text``; a null text is empty, a null id comes first,
    rows with the same id stay in the order of their texts. Each document ends with
    ``end_id``. Files appear under a name of their own for each attempt and count only once the list names
    them, so a task that ran twice leaves no second copy behind in the data.

    Columns: file, first_doc_id, n_docs, n_ids, n_bytes, boundary_bytes, first_id (ids in all files
    before), part. An empty table gives no file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = name = None
        enc = encoder(tokenizer)
        end = end_id.to_bytes(enc.width, "little")
        for part in slices(batches):
            if writer is None:
                name = f"{uuid.uuid4().hex}.ids"
                store, path = fs.FileSystem.from_uri(folder)
                store.create_dir(path, recursive=True)
                writer = TokenWriter(store.open_output_stream(f"{path}/{name}"), enc.width)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(texts(part))):
                writer.add(doc_id, ids + end)
        if writer is not None:
            size, boundary = writer.close()
            yield batch(
                {
                    "file": [name],
                    "first_doc_id": [writer.ids[0]],
                    "n_docs": [len(writer.ids)],
                    "n_ids": [writer.ends[-1]],
                    "n_bytes": [size],
                    "boundary_bytes": [boundary],
                },
                MANIFEST,
            )

    written = stored(
        ordered.mapInArrow(write, "file string, first_doc_id long, n_docs long, n_ids long, n_bytes long, boundary_bytes long")
        .withColumn("part", F.spark_partition_id()),
        "token-files",
    )  # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """One row for each document in the files: its place in the whole array, its length and the CRC-32 of its ids as four bytes each."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for part in batches:
            for row in part.to_pylist():
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    reader = TokenReader(source)
                    yield from _documents(reader, row["first_id"])

    spread = files.select("file", "first_id").repartition(F.col("file"))
    return spread.mapInArrow(read, DOCUMENTS)


def _documents(reader: TokenReader, first_id: int, ids_at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    done = 0
    while done < reader.n_docs:
        many = min(reader.n_docs, done + 4096)
        ends = reader.boundaries.range(done, many + 1)
        while done < many:
            k = int(np.searchsorted(ends, ends[0] + ids_at_once, side="right")) - 1
            k = max(1, min(k, len(ends) - 1))
            data = reader.ids(int(ends[0]), int(ends[k])).astype("<u4")
            cuts = (ends[: k + 1] - ends[0]).tolist()
            yield batch(
                {
                    "doc_id": reader.doc_ids(done, done + k),
                    "start": ends[:k] + first_id,
                    "n_tokens": np.diff(ends[: k + 1]),
                    "ids_crc32": [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])],
                },
                _DOCUMENTS,
            )
            done, ends = done + k, ends[k:]


def token_folder(spark: SparkSession) -> str:
    """A fresh folder for token files below the shared folder."""
    return shared_path(spark, "ids")
