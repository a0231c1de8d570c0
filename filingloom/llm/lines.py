"""Lines that several documents share, kept once, found through two Bloom filters.

Every key (a line without outer white space, in lower case) is hashed. The hash space is cut into slices; each
slice's task streams its hashes through a once-seen filter, and a hash that is already there enters the
twice-seen filter. The once-seen filters live only in these tasks and grow with the input. The twice-seen
filter has a fixed size, so it can be sent to every task; if it fills up, more lines are suspected and
confirmed, and the result stays the same. Only suspected lines shuffle, as 16-byte digests, to
confirm the repeat and choose the first document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import Stage, documents, free_name, importable

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PROBES = 4
_FLUSH = 2_000_000  # hashes a task gathers before it sends them to their slices
_ONCE_CAPACITY = 1 << 20  # hashes in one once-seen filter; a slice with more chains filters
_ONCE_BITS = 12 * _ONCE_CAPACITY
TWICE_BITS = 1 << 27  # 16 MB, at every size of the input
LAST = 2**63 - 1  # stands for a null document id, which comes after all others


class Bloom:
    """A Bloom filter over arrays of 64-bit hashes."""

    def __init__(self, bits: int, data: np.ndarray | None = None) -> None:
        self.bits = bits
        self.data = np.zeros(-(-bits // 8), np.uint8) if data is None else data

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        a, b = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(_PROBES):
            yield (a + np.uint64(k) * b) % np.uint64(self.bits)

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.data, at >> np.uint64(3), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            found &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def line_key(line: bytes, least: int) -> bytes | None:
    """The key of a line, or nothing if it has fewer code points than needed."""
    key = line.strip().lower()  # of bytes: the six ASCII white space characters, and A-Z
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def _keys(text: str | None, least: int) -> set[bytes]:
    keys = {line_key(x, least) for x in (text or "").encode().split(b"\n")}
    keys.discard(None)
    return keys


def _hashes(keys) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def _slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((hashes * _MIX) >> np.uint64(40)) % np.uint64(slices)


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def twice_seen(texts: DataFrame, least: int, slices: int, twice_bits: int) -> np.ndarray:
    """The twice-seen filter, a bit map for each slice, of all keys found in two rows or more (and, rarely, of others)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flushed() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            at = _slice_of(hashes, slices)
            order = np.argsort(at, kind="stable")
            hashes, twice = hashes[order], counts[order] > 1
            found, starts = np.unique(at[order], return_index=True)
            parts, flags = np.split(hashes, starts[1:]), np.split(twice, starts[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int32)), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([p[f].tobytes() for p, f in zip(parts, flags, strict=True)], pa.binary())],
                names=["slice", "once", "twice"])

        for batch in batches:
            for text in batch.column(0):
                if len(own := _hashes(_keys(text.as_py(), least))):
                    held.append(own)
            if sum(map(len, held)) >= _FLUSH:
                yield flushed()
                held = []
        if held:
            yield flushed()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, loaded, twice = None, [], 0, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([twice.data.tobytes()], pa.binary())], names=["slice", "bits"])
        for batch in batches:
            for at, first, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != current:
                    if twice is not None:
                        yield done()
                    current, once, loaded, twice = at, [Bloom(_ONCE_BITS)], 0, Bloom(twice_bits // slices)
                hashes = np.frombuffer(first, np.uint64)
                seen = np.zeros(len(hashes), bool)
                for f in once:
                    seen |= f.has(hashes)
                twice.add(np.frombuffer(again, np.uint64))
                twice.add(hashes[seen])
                if loaded + len(hashes) > _ONCE_CAPACITY and loaded:
                    once.append(Bloom(_ONCE_BITS))
                    loaded = 0
                once[-1].add(hashes[~seen])
                loaded += len(hashes)
        if twice is not None:
            yield done()

    sent = texts.mapInArrow(send, "slice int, once binary, twice binary")
    built = sent.repartition("slice").sortWithinPartitions("slice").mapInArrow(build, "slice int, bits binary")
    bits = np.zeros((slices, twice_bits // slices // 8), np.uint8)
    for row in built.toLocalIterator(prefetchPartitions=True):
        bits[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return bits


def dedup_lines(docs: DataFrame, least: int = 10, slices: int | None = None, twice_bits: int = TWICE_BITS,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
    """Documents without the lines that another document with a smaller id has; returns the frame and two names.

    Lines are what stands between line feeds. Keys shorter than least code points are left alone. A key found in two
    documents or more stays, each time it occurs, in the document with the smallest id, and goes elsewhere. A null text
    is an empty line. Rows with one id are one document; rows with a null id are one that comes last. All columns
    are kept, with the text replaced; two new ones count a text's lines and those dropped.
    slices: parts of the hash space, by default four for each of the session's shuffle partitions.
    """
    spark = docs.sparkSession
    importable(spark)
    stage = Stage(spark)
    slices = slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = 1 << min(max(slices - 1, 1).bit_length(), (twice_bits // 64).bit_length() - 1)
    per_slice = twice_bits // slices
    place, drop, out = (free_name(docs, n) for n in ("line_doc", "line_drop", "line_out"))
    doc_id = F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST))
    shared = spark.sparkContext.broadcast(twice_seen(docs.select(text_col), least, slices, twice_bits))

    def suspected(keys: list[bytes]) -> np.ndarray:
        hashes = _hashes(keys)
        at = _slice_of(hashes, slices)
        whole = Bloom(per_slice, shared.value.reshape(-1))
        found = np.ones(len(keys), bool)
        for probe in whole._places(hashes):
            place_of = at * np.uint64(per_slice) + probe
            found &= (whole.data[place_of >> np.uint64(3)] >> (place_of & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            counts = []
            for text in batch.column(1):
                own = _keys(text.as_py(), least)
                keys.extend(own)
                counts.append(len(own))
            if keys:
                found = suspected(keys)
                ids = np.repeat(batch.column(0).to_numpy(), counts)[found]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([_digest(keys[i]) for i in np.flatnonzero(found)], pa.binary())], names=["doc", "key"])

    found = stage.write(docs.select(doc_id.alias("doc"), F.col(text_col)).mapInArrow(suspects, "doc bigint, key binary"), "line-suspects")
    first = found.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last").select("key", "first")
    repeats = stage.write(first, "line-repeats")  # as a table of its own, so that the join can split a hot key
    drops = found.join(repeats, "key").filter("doc > first").groupBy(F.col("doc").alias(place)).agg(F.collect_set("key").alias(drop))

    @F.arrow_udf("text string, n_lines bigint, n_dropped bigint")
    def rebuilt(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, dropped in columns:
            new, n_lines, n_dropped = [], [], []
            for text, keys in zip(texts, dropped, strict=True):
                whole, keys = text.as_py() or "", set(keys.as_py() or ())
                lines = whole.encode().split(b"\n")
                kept = [x for x in lines if (k := line_key(x, least)) is None or _digest(k) not in keys] if keys else lines
                new.append(b"\n".join(kept).decode() if keys and text.is_valid else text.as_py())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=["text", "n_lines", "n_dropped"])

    joined = docs.withColumn(place, doc_id).join(drops, place, "left").withColumn(out, rebuilt(F.col(text_col), F.col(drop)))
    lines, dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    kept = [F.col(f"{out}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*kept, F.col(f"{out}.n_lines").alias(lines), F.col(f"{out}.n_dropped").alias(dropped)), lines, dropped


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of every document, and a digest of what stays."""
    out, lines, dropped = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col(lines).alias("n_lines"), F.col(dropped).alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# Expects a table named source_docs; gives doc_id, the whole text and the text that is kept.
LINES_SQL = r"""
line AS (SELECT doc_id, pos, x, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
         FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM source_docs)),
repeated AS (SELECT k, min(doc_id) AS first_doc FROM line WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
deduped AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE l.doc_id > r.first_doc) AS n_dropped,
                   coalesce(string_agg(l.x, chr(10) ORDER BY pos) FILTER (WHERE r.k IS NULL OR l.doc_id = r.first_doc), '') AS kept
            FROM line l LEFT JOIN repeated r ON l.k = r.k GROUP BY l.doc_id)
"""

OP8_SQL = f"""WITH source_docs AS (SELECT doc_id, text FROM documents), {LINES_SQL}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM deduped
"""
