"""Token ids of documents in binary shards, with Elias-Fano coded boundaries.

A shard holds the ids of a range of documents one after the other, two bytes each
(four where the vocabulary needs it). Where documents end, and their doc_ids, are
non-decreasing sequences; each takes about ``2 + log2(universe / n)`` bits an entry:
the low bits packed, the high bits in unary. A sample of every 256th one bit, kept
in 32 bits, lets ``select`` find an entry without a 64-bit table.

A shard is written once, front to back: ids, coded sequences, and a trailer that
says where they are. Its name is new in each attempt; only the names in the
manifest, a table that Spark commits, count. A lost executor leaves at most a file
that nobody reads.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import store, text_slices
from shelfmark.llm.tokens import END_OF_DOCUMENT, default_tokenizer, encoder
from shelfmark.session import new_work_dir

MAGIC = b"SHELFIDS"
SAMPLE = 256
#: Entries, universe, bits of a low part, bytes of low and high parts and of the sample.
_SEQUENCE = struct.Struct("<QQBQQQ")
#: Id width, documents, documents with null doc_id, ids, least doc_id, and the places of
#: the two sequences.
_TRAILER = struct.Struct("<BQQQqQQ8s")


class EliasFano:
    """A non-decreasing sequence of integers from 0 to ``universe``."""

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: bytes, sample: bytes):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.sample = np.frombuffer(sample, "<u4")

    @classmethod
    def of(cls, values) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = int(values[-1]) if n else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        if len(bits) >= 1 << 32:
            raise ValueError("a shard is too large; write more shards")
        high = np.packbits(bits, bitorder="little")
        return cls(n, universe, low_bits, low.tobytes(), high.tobytes(), ones[::SAMPLE].astype("<u4").tobytes())

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.sample.tobytes()]
        head = _SEQUENCE.pack(self.n, self.universe, self.low_bits, *map(len, parts))
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, universe, low_bits, *sizes = _SEQUENCE.unpack_from(data)
        parts, at = [], _SEQUENCE.size
        for size in sizes:
            parts.append(data[at : at + size])
            at += size
        return cls(n, universe, low_bits, *parts)

    def _low_of(self, first: int, last: int) -> np.ndarray:
        """Low parts of entries first to last - 1."""
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        start, end = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : -(-end // 8)], bitorder="little")
        bits = bits[start % 8 : start % 8 + end - start].reshape(-1, self.low_bits).astype(np.uint64)
        return (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """Entry i: from the sample before it, count one bits a byte at a time."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.sample[i // SAMPLE])
        left, byte = i % SAMPLE, place // 8
        word = int(self.high[byte]) >> (place % 8) << (place % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = 8 * byte + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | int(self._low_of(i, i + 1)[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        return high | self._low_of(0, self.n)


class ShardWriter:
    """Writes one shard to any file system that Arrow knows by its URI."""

    def __init__(self, uri: str, width: int):
        self.system, self.path = _place(uri)
        self.width, self.count, self.nulls = width, 0, 0
        self.ends: list[int] = []
        self.doc_ids: list[int] = []
        self.out = None

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """The next document, in ascending doc_id order, nulls first."""
        if self.out is None:
            self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
            self.out = self.system.open_output_stream(self.path)
        found = np.frombuffer(ids, "<u4")
        self.out.write(found.astype(f"<u{self.width}").tobytes())
        self.count += len(found)
        self.ends.append(self.count)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        least = self.doc_ids[0] if self.doc_ids else 0
        ends = EliasFano.of(self.ends).to_bytes()
        known = EliasFano.of([d - least for d in self.doc_ids]).to_bytes()
        self.out.write(ends + known)
        at = self.count * self.width
        self.out.write(
            _TRAILER.pack(self.width, len(self.ends), self.nulls, self.count, least, at, at + len(ends), MAGIC)
        )
        self.out.close()


class ShardReader:
    def __init__(self, uri: str):
        system, path = _place(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        trailer = self.file.read_at(_TRAILER.size, size - _TRAILER.size)
        (self.width, self.documents, self.nulls, self.count, self.least, ends_at, ids_at, magic) = (
            _TRAILER.unpack(trailer)
        )
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a shard of ids")
        self.ends = EliasFano.from_bytes(self.file.read_at(ids_at - ends_at, ends_at))
        self.known = EliasFano.from_bytes(self.file.read_at(size - _TRAILER.size - ids_at, ids_at))

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, found through select."""
        return self.ids(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def ids(self, first: int, last: int) -> np.ndarray:
        data = self.file.read_at((last - first) * self.width, first * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.least + int(v) for v in self.known.all()]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes file:/a where a URI has file:///a.
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark itself would find it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """Write every document's ids to shards under ``folder``; return the manifest
    (shard, uri, documents, ids, first_id).

    Shards are ranges of doc_id in ascending order, nulls first; equal doc_ids are
    ordered by the text's hash. A null text has no ids but the end id, like an empty one.
    """
    end = np.array([end_id], "<u4").tobytes()
    folder = _qualified(docs.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        uri = f"{folder.rstrip('/')}/shard-{shard:08d}-{uuid.uuid4().hex}.ids"
        out = ShardWriter(uri, pieces.width)
        for batch in text_slices(batches):
            encoded = pieces.encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                out.add(doc_id, ids + end)
        if out.ends:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "uri": [uri], "documents": [len(out.ends)], "ids": [out.count]}
            )

    order = ("doc_id", F.xxhash64("text"))
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = store(
        ordered.mapInArrow(write, "shard bigint, uri string, documents bigint, ids bigint"), "manifest"
    )
    # One row for each shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame) -> DataFrame:
    """One row per document from the shards: doc_id, start, n_tokens, ids_crc32."""
    shards = max(1, manifest.count())

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri, first_id in zip(frame["uri"], frame["first_id"]):
                shard = ShardReader(uri)
                ends = shard.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                crcs = np.fromiter(
                    (zlib.crc32(shard.ids(a, b).tobytes()) for a, b in zip(starts.tolist(), ends.tolist())),
                    np.int64, len(ends),
                )
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(shard.doc_ids(), "Int64"),
                        "start": starts + first_id,
                        "n_tokens": ends - starts,
                        "ids_crc32": crcs,
                    }
                )

    spread = manifest.select("shard", "uri", "first_id").repartitionByRange(shards, "shard")
    return spread.mapInPandas(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op8_elias_fano(spark, docs: DataFrame) -> DataFrame:
    folder = new_work_dir(spark, "ids")
    return read_ids(write_ids(docs, folder, default_tokenizer()))
