"""Best-fit packing of token sequences by a tree of rounds.

Each partition packs its own pieces best-fit, largest first. Bins that are nearly full are done; the
others become the items of the next round, on fewer partitions, until one partition is left or a round
no longer helps. A task never holds more than a set number of items, whatever the size of the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import Stage, documents
from filingloom.llm.tokens import encoded

_MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BINS = "bin bigint, size bigint, members array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>>"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: for each item its bin (numbered from 0) and its offset there.

    Bins are kept by the room they have left; a bit mask over the rooms finds the tightest one that is enough.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms, n_bins = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if enough := rooms >> size:
            room = size + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, n_bins = capacity, n_bins, n_bins + 1
        bins[i], offsets[i] = b, capacity - room
        if left := room - size:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins, offsets


def _packed(sizes: np.ndarray, members: pa.ListArray, capacity: int, first_bin: int) -> pa.RecordBatch:
    """Bins made of items; each item brings its members, whose offsets move with it."""
    bins, offsets = best_fit(sizes, capacity)
    order = np.lexsort((offsets, bins))
    members = members.take(pa.array(order))
    counts = np.diff(members.offsets.to_numpy())
    flat = members.flatten()
    fields = [flat.field(k) for k in range(_MEMBER.num_fields)]
    fields[5] = pa.array(fields[5].to_numpy() + np.repeat(offsets[order], counts))
    n = int(bins.max()) + 1
    per_bin = np.bincount(bins[order], weights=counts, minlength=n).astype(np.int64)
    out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_bin)]).astype(np.int32)), pa.StructArray.from_arrays(fields, fields=list(_MEMBER)))
    total = np.bincount(bins, weights=sizes, minlength=n).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(first_bin + np.arange(n)), pa.array(total), out], names=["bin", "size", "members"])


def bin_number(round_no: int, task: int, made: int) -> int:
    """The number of a task's next bin, after those it has made: 5 bits for the round, 22 for the task, 36 for the bin."""
    if round_no >= 1 << 5 or task >= 1 << 22 or made + (1 << 24) >= 1 << 36:
        raise OverflowError("too many rounds, tasks or bins for a number of 63 bits")
    return (round_no << 58) | (task << 36) | made


def pack_documents(docs: DataFrame, capacity: int = 4096, tokenizer: str = "word_bpe_49k.json", kind: str = "words", end_id: int = 1,
                   slack: int = 8, fan_in: int = 8, max_items: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most capacity tokens; returns one row per piece.

    A document is its ids and the end id; a null or empty text is the end id alone. Only a longer document is
    cut, into pieces of capacity tokens and a last one. Null and repeated document ids are packed row by row.
    slack: a bin with at most so much room left is done. fan_in: partitions merged into one in a round.
    max_items: items a task packs at a time. Sequence numbers are unique, not dense. No documents: no rows.
    """
    spark = docs.sparkSession
    stage = Stage(spark)
    names = [f.name for f in _MEMBER]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        pieces: list[tuple] = []
        made = 0

        def packed() -> pa.RecordBatch:
            nonlocal made
            columns = list(zip(*pieces, strict=True))
            flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MEMBER, strict=True)], fields=list(_MEMBER))
            members = pa.ListArray.from_arrays(pa.array(np.arange(len(pieces) + 1, dtype=np.int32)), flat)
            out = _packed(np.array(columns[3], np.int64), members, capacity, bin_number(1, TaskContext.get().partitionId(), made))
            made += out.num_rows
            return out

        for doc_id, coded in encoded(batches, tokenizer, kind):
            coded += end
            for piece, at in enumerate(range(0, len(coded), 4 * capacity)):
                part = coded[at : at + 4 * capacity]
                pieces.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), 0))
            if len(pieces) >= max_items:
                yield packed()
                pieces = []
        if pieces:
            yield packed()

    def again(round_no: int):
        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            made = 0

            def packed() -> pa.RecordBatch:
                nonlocal made
                table = pa.Table.from_batches(held).combine_chunks()
                sizes = table.column("size").to_numpy()
                members = table.column("members").combine_chunks()
                out = _packed(sizes, members, capacity, bin_number(round_no, TaskContext.get().partitionId(), made))
                made += out.num_rows
                return out

            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= max_items:
                    yield packed()
                    held = []
            if held:
                yield packed()

        return merge

    input_rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    bins = stage.write(input_rows.mapInArrow(first, _BINS), "bins-1")
    done = bins.filter(F.col("size") >= capacity - slack)
    left = bins.filter(F.col("size") < capacity - slack)
    n_left, parts, round_no = left.count(), max(1, bins.rdd.getNumPartitions()), 1
    while n_left > 1:
        round_no += 1
        parts = max(1, -(-parts // fan_in), -(-n_left // max_items))
        bins = stage.write(left.repartition(parts, "bin").mapInArrow(again(round_no), _BINS), f"bins-{round_no}")
        done = done.unionAll(bins.filter(F.col("size") >= capacity - slack))
        left = bins.filter(F.col("size") < capacity - slack)
        before, n_left = n_left, left.count()
        if parts == 1 or (parts == -(-before // max_items) and n_left > 0.95 * before):
            break
    pieces = done.unionAll(left).select(F.col("bin").alias("sequence_id"), F.explode("members").alias("m"))
    return pieces.select(*[F.col(f"m.{n}").alias(n) for n in names], "sequence_id")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack_documents(documents(spark, sf_dir)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
