"""Token ids as length-delimited binary records with masked checksums, and an offset index beside each file.

A record is framed as: length (unsigned 64-bit), masked CRC-32C of the length, the payload, masked CRC-32C
of the payload, all little-endian. The payload holds one text's ids, in two bytes each if the vocabulary
allows it, else four. The index has one entry of 24 bytes for each record, in file order: document id,
offset of the record, number of ids (signed 64-bit each), so that a reader can fetch records in any order.
"""

from __future__ import annotations

import posixpath
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import Stage, documents, importable
from filingloom.llm.crc32c import crc32c, masked
from filingloom.llm.tokens import encoded, encoder
from filingloom.sources.snapshots import new_path

MANIFEST = "shard int, path string, index_path string, width int, n_docs bigint, n_tokens bigint, n_bytes bigint"
READ_BACK = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int, record_offset bigint"
_HEAD, _FOOT = 12, 4
_INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("n", "<i8")])
_SLICE = 4 << 20  # bytes of payload framed or read at a time
NO_ID = -(2**63)  # stands for a null document id in the index


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def frame(payloads: list[bytes]) -> list[bytes]:
    """The framed records of some payloads."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, feet = masked(crc32c(lengths)).tolist(), masked(crc32c(payloads)).tolist()
    return [n + struct.pack("<I", h) + p + struct.pack("<I", f) for n, h, p, f in zip(lengths, heads, payloads, feet, strict=True)]


def _unframe(block: bytes, offsets: list[int], sizes: list[int]) -> list[bytes]:
    """The payloads of framed records in a block; raises on any damaged record."""
    lengths = [block[o : o + 8] for o in offsets]
    payloads = [block[o + _HEAD : o + s - _FOOT] for o, s in zip(offsets, sizes, strict=True)]
    heads = [struct.unpack_from("<I", block, o + 8)[0] for o in offsets]
    feet = [struct.unpack_from("<I", block, o + s - _FOOT)[0] for o, s in zip(offsets, sizes, strict=True)]
    if (
        [struct.unpack("<Q", n)[0] for n in lengths] != [len(p) for p in payloads]
        or masked(crc32c(lengths)).tolist() != heads
        or masked(crc32c(payloads)).tolist() != feet
    ):
        raise ValueError("damaged record")
    return payloads


def read_record(path: str, offset: int, n_ids: int, width: int = 2) -> np.ndarray:
    """One record's ids, by its index entry."""
    store, name = _open(path)
    with store.open_input_file(name) as f:
        size = _HEAD + n_ids * width + _FOOT
        return np.frombuffer(_unframe(f.read_at(size, offset), [0], [size])[0], f"<u{width}")


def write_records(docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", kind: str = "bytes",
                  end_id: int = 0, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write every text's ids, an end id after each, into files in ascending order of id; returns the manifest.

    Rows are dealt by ranges of the id, so file k holds smaller ids than file k+1. Rows with a null id come first,
    rows of one id in order of their text. A null or empty text is its end id alone. An attempt of a task writes under
    a name of its own, and only the manifest says which files count, so a repeated task does no harm.
    shards: number of ranges; by default the session's shuffle partitions, small ones merged by Spark.
    The folder is one that pyarrow's file systems can open on every executor. No rows: no files.
    """
    importable(docs.sparkSession)
    ordered = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = (ordered.repartitionByRange(shards, "doc_id") if shards else ordered.repartitionByRange("doc_id")).sortWithinPartitions("doc_id", "text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 if max(encoder(tokenizer, kind).tokenizer.get_vocab_size(), end_id + 1) <= 65536 else 4
        end = struct.pack("<I", end_id)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        paths = [f"{folder}/{name}{kind}" for kind in (".records", ".index")]
        files = [store.open_output_stream(posixpath.join(root, posixpath.basename(p))) for p in paths]
        total = n_docs = n_tokens = 0

        def flush(ids: list[int | None], payloads: list[bytes]) -> int:
            records = frame(payloads)
            entries = np.zeros(len(ids), _INDEX)
            sizes = np.array([len(r) for r in records], np.int64)
            entries["doc_id"] = [NO_ID if i is None else i for i in ids]
            entries["offset"] = total + np.cumsum(sizes) - sizes
            entries["n"] = (sizes - _HEAD - _FOOT) // width
            files[0].write(b"".join(records))
            files[1].write(entries.tobytes())
            return int(sizes.sum())

        ids: list[int | None] = []
        payloads: list[bytes] = []
        held = 0
        for doc_id, coded in encoded(batches, tokenizer, kind):
            coded += end
            n_docs, n_tokens = n_docs + 1, n_tokens + len(coded) // 4
            if width == 2:
                coded = np.frombuffer(coded, "<u4").astype("<u2").tobytes()
            ids.append(doc_id)
            payloads.append(coded)
            held += len(coded)
            if held >= _SLICE:
                total += flush(ids, payloads)
                ids, payloads, held = [], [], 0
        if ids:
            total += flush(ids, payloads)
        for f in files:
            f.close()
        if n_docs:
            row = [task.partitionId(), *paths, width, n_docs, n_tokens, total]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                                             names=["shard", "path", "index_path", "width", "n_docs", "n_tokens", "n_bytes"])

    return ordered.mapInArrow(shard, MANIFEST)


def read_back(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read the files of a manifest: one row per record with its place in the whole sequence of ids and their checksum.

    The manifest has one row per file, so the running totals over it are kept by the driver.
    """
    importable(spark)
    files, start = [], 0
    for m in sorted(manifest.collect(), key=lambda m: m.shard):
        files.append((m.shard, m.path, m.index_path, m.width, start))
        start += m.n_tokens
    listed = spark.createDataFrame(files, "shard int, path string, index_path string, width int, start bigint")
    if files:
        listed = listed.repartition(len(files), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in batch.to_pylist():
                start = m["start"]
                store, name = _open(m["index_path"])
                with store.open_input_stream(name) as f:
                    index = np.frombuffer(f.read(), _INDEX)
                store, name = _open(m["path"])
                with store.open_input_stream(name) as f:
                    sizes = _HEAD + index["n"] * m["width"] + _FOOT
                    if (index["offset"] != np.cumsum(sizes) - sizes).any():
                        raise ValueError("the index does not fit its file")
                    turn = np.cumsum(sizes) // _SLICE
                    for rows in np.split(np.arange(len(index)), np.flatnonzero(np.diff(turn)) + 1):
                        if not len(rows):
                            continue
                        own = sizes[rows]
                        payloads = _unframe(f.read(int(own.sum())), (np.cumsum(own) - own).tolist(), own.tolist())
                        n = index["n"][rows]
                        ids = index["doc_id"][rows]
                        crcs = [zlib.crc32(np.frombuffer(p, f"<u{m['width']}").astype("<u4").tobytes()) for p in payloads]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, mask=ids == NO_ID), pa.array(start + np.cumsum(n) - n), pa.array(n.astype(np.int64)), pa.array(crcs, pa.int64()),
                             pa.array(np.full(len(rows), m["shard"], np.int32)), pa.array(index["offset"][rows].astype(np.int64))],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "record_offset"])
                        start += int(n.sum())

    return listed.mapInArrow(read, READ_BACK)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as records in order of doc_id and read back."""
    manifest = write_records(documents(spark, sf_dir), new_path(spark, "llm-records"))
    return read_back(spark, Stage(spark).write(manifest, "manifest"))
