"""Documents packed into sequences by deficit round-robin over their sources.

Each source is a queue: the token stream of its documents, served a quantum at a
time. A queue earns credit in proportion to its weight, and its j-th quantum is due
when the credit reaches ``j + 1/2`` quanta, at time ``(j + 1/2) / weight``. Serving
quanta in the order of these times is the round-robin with deficits: what a window
leaves owing to a source is in its next due time, in this window, the next one or
the next partition. A source's share therefore never strays from its target by more
than about a quantum, however far into the corpus, and no task has to go through the
queues in turn: due times are sorted by range and lengths added up by
:func:`running_totals`. A queue that runs out leaves its share to the others.

Every window is filled; only the last sequence is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import running_totals, store, text_slices
from shelfmark.llm.tokens import END_OF_PACKED, default_tokenizer, encoder

LENGTH = 2048
#: Quanta in a window: cuts of a document are this much shorter than a sequence.
QUANTA = 8


def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_OF_PACKED) -> DataFrame:
    """Stored ids of each document: key, doc_id, queue, n_tokens, ids (compressed
    little-endian 32-bit). ``queue`` is the source; null has a queue of its own."""
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(tokenizer)
        packer = zstandard.ZstdCompressor(level=1)
        for batch in text_slices(batches):
            ids = [found + end for found in pieces.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "queue": batch.column("queue"),
                    "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                    "ids": pa.array([packer.compress(i) for i in ids], pa.binary()),
                }
            )

    queue = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), queue.alias("queue"), "text")
    made = read.mapInArrow(encode, "doc_id bigint, queue string, n_tokens bigint, ids binary")
    return store(made.withColumn("key", F.monotonically_increasing_id()), "tokens")


def schedule(
    tokens: DataFrame, length: int = LENGTH, quanta: int = QUANTA, weights: Column | None = None
) -> DataFrame:
    """Where each piece of each document goes: key, start, length, sequence_id, offset.

    ``weights`` is a column over ``queue``; by default each queue weighs as many
    tokens as it holds, so that all run out together.
    """
    quantum = max(1, length // quanta)
    narrow = tokens.select("key", "queue", "n_tokens")
    queued = running_totals(narrow, {"before": F.col("n_tokens")}, ["key"], "queue")
    held = tokens.groupBy("queue").agg(F.sum("n_tokens").alias("held"))
    held = held.withColumn("weight", (weights if weights is not None else F.col("held")).cast("double"))
    last = F.col("before") + F.col("n_tokens")
    slots = F.sequence(F.floor(F.col("before") / quantum), F.floor((last - 1) / quantum))
    pieces = queued.select("key", "queue", "before", last.alias("end"), F.explode(slots).alias("slot"))
    first = F.greatest("before", F.col("slot") * quantum)
    pieces = pieces.select(
        "key", "queue", "slot",
        (first - F.col("before")).alias("start"),
        (F.least("end", (F.col("slot") + 1) * quantum) - first).alias("length"),
        (first - F.col("slot") * quantum).alias("into"),
    )
    # The piece at the front of a quantum stands for it.
    due = pieces.where("into = 0").join(held, "queue").select(
        "queue", "slot",
        ((F.col("slot") + F.lit(0.5)) / F.col("weight")).alias("due"),
        F.least(F.lit(quantum), F.col("held") - F.col("slot") * quantum).alias("filled"),
    )
    served = running_totals(due, {"place": F.col("filled")}, ["due", "queue"])
    placed = pieces.join(served.select("queue", "slot", "place"), ["queue", "slot"])
    at = F.col("place") + F.col("into")
    room = F.lit(length) - F.pmod(at, F.lit(length))
    whole = F.struct("start", "length", at.alias("at"))
    cut = F.array(
        F.struct(F.col("start"), room.alias("length"), at.alias("at")),
        F.struct((F.col("start") + room).alias("start"), (F.col("length") - room).alias("length"), (at + room).alias("at")),
    )
    parts = F.when(F.col("length") <= room, F.array(whole)).otherwise(cut)
    placed = placed.select("key", F.explode(parts).alias("p")).select("key", "p.*")
    return placed.select(
        "key", "start", "length",
        F.floor(F.col("at") / length).alias("sequence_id"), F.pmod("at", F.lit(length)).alias("offset"),
    )


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, quanta: int = QUANTA,
    weights: Column | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source, and the ids themselves if asked for.

    A null text is as an empty one: its end id alone. Documents that share a doc_id
    are packed each on its own. No documents, no pieces.
    """
    tokens = token_table(docs, tokenizer)
    pieces = schedule(tokens, length, quanta, weights)
    fields = ("start", "length", "sequence_id", "offset")
    # The pieces of one document, as many as its tokens need.
    listed = pieces.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("pieces"))
    joined = listed.join(tokens, "key").select(
        "doc_id", F.when(F.col("queue") != "null", F.expr("substr(queue, 2)")).alias("source"),
        "n_tokens", "ids", *(F.col(f"pieces.{f}").alias(f) for f in fields),
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            counts = pc.list_value_length(batch.column("start")).to_numpy(zero_copy_only=False)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            out = {name: batch.column(name).flatten() for name in fields}
            cuts = zip(rows.to_pylist(), out["start"].to_pylist(), out["length"].to_pylist())
            found, held, data = [], -1, b""
            for row, start, size in cuts:
                if row != held:
                    data, held = memoryview(unpacker.decompress(batch.column("ids")[row].as_py())), row
                found.append(data[4 * start : 4 * (start + size)])
            out |= {
                "ids_crc32": pa.array(map(zlib.crc32, found), pa.int64()),
                "doc_id": batch.column("doc_id").take(rows),
                "source": batch.column("source").take(rows),
                "doc_tokens": batch.column("n_tokens").take(rows),
            }
            if with_ids:
                out["ids"] = pa.array([np.frombuffer(d, "<u4").astype(np.int32) for d in found])
            yield pa.RecordBatch.from_pydict({name: out[name] for name in names})

    names = (
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source",
        *["ids"] * with_ids,
    )
    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, source string"
    )
    return joined.mapInArrow(measure, schema + ", ids array<int>" * with_ids)


def op4_packing(spark, docs: DataFrame) -> DataFrame:
    return pack(docs, default_tokenizer())
