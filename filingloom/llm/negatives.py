"""Hard negatives: for an anchor and its positives, the rows of other labels that score nearly as well.

Candidates lie in Parquet files in the order of a Hilbert curve, a row group for each block of vectors, and a zone map
holds every block's least and greatest value of each dimension. The inner product of an anchor with any vector of a
block lies in an interval that follows from these alone; a block is read for an anchor only if that interval meets the
scores the anchor still looks for.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.llm.common import Stage, importable
from filingloom.llm.search import quantised
from filingloom.sources.snapshots import new_path

BLOCK, BLOCK_BYTES = 256, 1 << 20  # vectors of a block, and what they take at most if there are several
TASK_BLOCKS = 64  # blocks that one task looks at
ANCHOR_BYTES = 4 << 20  # anchors sent to every task at a time
CURVE_DIMS, CURVE_BITS = 8, 7  # of the Hilbert curve
LENGTHS = 1000  # vector lengths whose curve is fitted to the data; the others use their first dimensions
SEEDS = 2  # blocks read first for each anchor
HELD = 512  # candidates of an anchor held before they are cut down
EXACT = 2.0**53

_ZONE = "file string, grp int, length int, n int, low array<bigint>, high array<bigint>, labels array<bigint>, counts array<bigint>"
_SCORED = "anchor int, vec_id bigint, score bigint"
_MINED = "anchor int, positive int, vec_id bigint, score bigint"


def hilbert(coords: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2 ** bits; one row per point.

    Skilling's transform: from the highest bit down, reflect or swap axes, then undo the Gray code.
    """
    x = coords.T.astype(np.int64).copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            t = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _curves(rows: DataFrame) -> dict[int, tuple[list[int], list[float], list[float]]]:
    """For the most frequent vector lengths: the dimensions of the largest variance, with their mean less and plus two deviations."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            lists = batch.column(0)
            lengths = lists.value_lengths().to_numpy()
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                x = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), int(n)).astype(float)
                own = total.setdefault(int(n), [np.zeros(1), np.zeros(int(n)), np.zeros(int(n))])
                own[0] += len(at)
                own[1] += x.sum(axis=0)
                own[2] += (x * x).sum(axis=0)
        for n, (count, x, y) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, n, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, count[0])), pa.array(x), pa.array(y)], names=["length", "dim", "n", "x", "y"])

    each = rows.select("v").mapInArrow(sums, "length int, dim int, n double, x double, y double").groupBy("length", "dim").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y")])
    each = each.withColumn("var", F.greatest(F.lit(0.0), F.col("y") / F.col("n") - (F.col("x") / F.col("n")) ** 2))
    by_dim = Window.partitionBy("length").orderBy(F.desc("var"), "dim")
    widest = each.withColumn("r", F.row_number().over(by_dim)).filter(F.col("r") <= CURVE_DIMS)
    curves = widest.groupBy("length").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("dim", (F.col("x") / F.col("n")).alias("mean"), F.sqrt("var").alias("dev")))).alias("d"))
    out = {}
    for r in curves.orderBy(F.desc("n"), "length").limit(LENGTHS).collect():
        out[r.length] = ([d.dim for d in r.d], [d.mean - 2 * d.dev for d in r.d], [d.mean + 2 * d.dev for d in r.d])
    return out


def _keyed(curves: dict) -> Callable:
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            lengths = lists.value_lengths().to_numpy()
            key = np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                if n == 0:
                    continue
                at = np.flatnonzero(lengths == n)
                x = lists.take(pa.array(at)).flatten().to_numpy().reshape(len(at), int(n)).astype(float)
                dims, low, high = curves.get(int(n), (list(range(min(int(n), CURVE_DIMS))), [-256.0] * CURVE_DIMS, [256.0] * CURVE_DIMS))
                low, high = np.array(low[: len(dims)]), np.array(high[: len(dims)])
                scaled = (x[:, dims] - low) / np.where(high > low, high - low, 1.0) * (1 << CURVE_BITS)
                key[at] = hilbert(np.clip(scaled, 0, (1 << CURVE_BITS) - 1).astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths.astype(np.int32)), pa.array(key)], names=["vec_id", "label", "v", "length", "place"])

    return keyed


def write_blocks(rows: DataFrame, folder: str) -> DataFrame:
    """Write vectors (vec_id, label, v) in Hilbert order, a row group for each block; returns the zone map.

    Rows of one vector, however many, are in order of their id and may lie in several files. An attempt of a task writes
    under a name of its own, and the zone map names only files of tasks that ended.
    """
    ordered = rows.mapInArrow(_keyed(_curves(rows)), "vec_id bigint, label bigint, v array<bigint>, length int, place bigint")
    ordered = ordered.repartitionByRange("length", "place", "vec_id", "label").sortWithinPartitions("length", "place", "vec_id", "label")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"blocks-{task.partitionId():06d}-{task.taskAttemptId()}.parquet"
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.binary())])
        zones: list[tuple] = []
        held: pa.Table | None = None
        writer = None

        def put(table: pa.Table) -> None:
            nonlocal writer
            length = int(table.column("length")[0].as_py())
            v = table.column("v").combine_chunks()
            x = v.flatten().to_numpy().reshape(len(table), length)
            small = np.int16 if length and np.abs(x.astype(float)).max() < 2**15 else np.int64
            raw = np.ascontiguousarray(x.astype(small))
            if writer is None:
                writer = pq.ParquetWriter(posixpath.join(root, name), schema, filesystem=store)
            width = raw.itemsize * length
            data = [raw[i].tobytes() for i in range(len(raw))] if width else [b""] * len(raw)
            writer.write_table(pa.table({"vec_id": table.column("vec_id"), "label": table.column("label"), "v": pa.array(data, pa.binary())}, schema=schema), row_group_size=len(table))
            labels, counts = np.unique(table.column("label").to_numpy(), return_counts=True)
            zones.append((f"{folder}/{name}", len(zones), length, len(table), x.min(axis=0).tolist(), x.max(axis=0).tolist(), labels.tolist(), counts.tolist()))

        def cut(table: pa.Table, last: bool) -> pa.Table | None:
            lengths = table.column("length").to_numpy()
            start = 0
            while start < len(lengths):
                same = int(np.searchsorted(lengths, lengths[start], side="right"))  # rows come sorted by length
                size = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, int(lengths[start])))))
                if same - start < size and same == len(lengths) and not last:
                    break
                end = min(start + size, same)
                put(table.slice(start, end - start))
                start = end
            return None if start == len(lengths) else table.slice(start)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            held = cut(held.combine_chunks(), False)
        if held is not None:
            cut(held, True)
        if writer is not None:
            writer.close()
        if zones:
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*zones, strict=True), kinds, strict=True)], names=[c.split()[0] for c in _ZONE.split(", ")])

    return ordered.mapInArrow(blocks, _ZONE)


class Anchors:
    """Anchors of one vector length, and what is known of the scores they look for."""

    def __init__(self, places: list[int], ids: list[int], labels: list[int], vectors: list[list[int]], length: int) -> None:
        self.places, self.ids, self.labels = np.array(places), np.array(ids, np.int64), np.array(labels, np.int64)
        self.matrix = np.array(vectors, np.int64).reshape(len(ids), length)
        self.least = np.full(len(ids), -np.inf)  # a score that the last positive reaches at least
        self.windows: list[list[tuple[int, int, int]]] = [[] for _ in ids]  # (positive's number, lowest, highest score)
        self.signs: tuple | None = None

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Between what each anchor's inner products with vectors of a block lie; widened by more than floats can err."""
        if self.signs is None:
            a = self.matrix.astype(float)
            self.signs = np.maximum(a, 0), np.minimum(a, 0)
        up, down = self.signs
        low, high = low.astype(float), high.astype(float)
        slack = 1 + 1e-9 * ((up - down) @ np.maximum(np.abs(low), np.abs(high)))
        edge = 2.0**63  # as scores are held
        return np.clip(up @ low + down @ high - slack, -edge, edge), np.clip(up @ high + down @ low + slack, -edge, edge)

    def scores(self, at: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Exact whole inner products; those beyond 64 bits are held at the largest or smallest number."""
        a = self.matrix[at]
        if a.shape[1] == 0:
            return np.zeros((len(a), len(vectors)), np.int64)
        if float(np.abs(a.astype(float)).max()) * float(np.abs(vectors.astype(float)).max()) * a.shape[1] < EXACT:
            return (a.astype(float) @ vectors.astype(float).T).astype(np.int64)
        return np.clip(a.astype(object) @ vectors.astype(object).T, -(2**63), 2**63 - 1).astype(np.int64)


def _zones(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for r in batch.to_pylist():
            r["low"], r["high"], r["labels"] = np.array(r["low"], np.int64), np.array(r["high"], np.int64), np.array(r["labels"], np.int64)
            yield r


def _reader() -> Callable:
    """Reads one block: ids, labels and vectors. The file read last stays open."""
    import pyarrow.parquet as pq

    open_file: list = [None, None]

    def read(zone: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if open_file[0] != zone["file"]:
            store, name = _open(zone["file"])
            open_file[:] = zone["file"], pq.ParquetFile(store.open_input_file(name))
        table = open_file[1].read_row_group(zone["grp"])
        raw = b"".join(table.column("v").to_pylist())
        kind = np.int16 if len(raw) == 2 * zone["length"] * len(table) else np.int64
        vectors = np.frombuffer(raw, kind) if raw else np.zeros(0, kind)
        return table.column("vec_id").to_numpy(), table.column("label").to_numpy(), vectors.reshape(len(table), zone["length"])

    return read


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _seeds(sent) -> Callable:
    """For each anchor the blocks with its label and the highest bound: anchor, rank of the bound, file, grp."""
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        for zone in _zones(batches):
            if (anchors := sent.value.get(zone["length"])) is None:
                continue
            high = anchors.bounds(zone["low"], zone["high"])[1]
            for i in np.flatnonzero(np.isin(anchors.labels, zone["labels"])):
                own = best.setdefault(int(anchors.places[i]), [])
                own.append((-float(high[i]), zone["file"], zone["grp"], zone["length"]))
                if len(own) > 8 * SEEDS:
                    own.sort()
                    del own[SEEDS:]
        rows = [(a, *z) for a, own in best.items() for z in sorted(own)[:SEEDS]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), pa.float64(), pa.string(), pa.int32(), pa.int32()], strict=True)], names=["anchor", "bound", "file", "grp", "length"])

    return seeds


def _positives(sent, k: int, given: bool) -> Callable:
    """The best rows of each anchor's label in blocks that may hold one: anchor, vec_id, score.

    given: the blocks come with the anchors to be looked up; else the zone map decides, by the score the anchor has reached,
    in other blocks or, from the highest bound down, in those read before.
    """
    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader()
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def look(anchors: Anchors, zone: dict, at: np.ndarray) -> None:
            ids, labels, vectors = read(zone)
            scores = anchors.scores(at, vectors)
            for i, own in zip(at.tolist(), scores, strict=True):
                mine = np.flatnonzero((labels == anchors.labels[i]) & (ids != anchors.ids[i]))
                before = found.get(int(anchors.places[i]), (np.zeros(0, np.int64),) * 2)
                all_ids, all_scores = np.concatenate([before[0], ids[mine]]), np.concatenate([before[1], own[mine]])
                best = _best(all_ids, all_scores, k)
                found[int(anchors.places[i])] = all_ids[best], all_scores[best]

        if given:
            for zone in (r for batch in batches for r in batch.to_pylist()):
                anchors = sent.value[zone["length"]]
                look(anchors, zone, np.flatnonzero(np.isin(anchors.places, zone["anchors"])))
        else:
            zones = [(z, a) for z in _zones(batches) if (a := sent.value.get(z["length"])) is not None]
            highs = [a.bounds(z["low"], z["high"])[1] for z, a in zones]
            for x in sorted(range(len(zones)), key=lambda x: -float(highs[x].max(initial=-np.inf))):
                zone, anchors = zones[x]
                want = np.isin(anchors.labels, zone["labels"]) & (highs[x] >= anchors.least)
                at = [i for i in np.flatnonzero(want) if (f := found.get(int(anchors.places[i]))) is None or len(f[0]) < k or highs[x][i] >= f[1][-1]]
                if at:
                    look(anchors, zone, np.array(at))
        rows = [(np.full(len(i), a, np.int32), i, s) for a, (i, s) in found.items() if len(i)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=["anchor", "vec_id", "score"])

    return positives


def _negatives(sent, k: int) -> Callable:
    """The best rows of other labels in each window of each anchor: anchor, positive, vec_id, score."""
    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader()
        held: dict[tuple[int, int], list] = {}  # (length, anchor in it) -> [number of rows, ids, scores]

        def chosen(windows: list, ids: np.ndarray, scores: np.ndarray) -> list[tuple[int, np.ndarray]]:
            """For each window the places of its best rows."""
            order = np.lexsort((ids, -scores))
            falling, out = -scores[order], []
            for number, low, high in windows:
                first = int(np.searchsorted(falling, -high, side="left"))
                some = order[first : first + k]
                out.append((number, some[scores[some] >= low]))
            return out

        def cut(anchors: Anchors, i: int, own: list) -> None:
            ids, scores = np.concatenate(own[1]), np.concatenate(own[2])
            kept = np.unique(np.concatenate([at for _, at in chosen(anchors.windows[i], ids, scores)]))
            own[0], own[1], own[2] = len(kept), [ids[kept]], [scores[kept]]

        for zone in _zones(batches):
            if (anchors := sent.value.get(zone["length"])) is None:
                continue
            low, high = anchors.bounds(zone["low"], zone["high"])
            other = (len(zone["labels"]) > 1) | (anchors.labels != zone["labels"][0])
            at = [i for i in np.flatnonzero(other) if any(high[i] >= w[1] and low[i] <= w[2] for w in anchors.windows[i])]
            if not at:
                continue
            ids, labels, vectors = read(zone)
            for i, own in zip(at, anchors.scores(np.array(at), vectors), strict=True):
                least, most = min(w[1] for w in anchors.windows[i]), max(w[2] for w in anchors.windows[i])
                mine = np.flatnonzero((labels != anchors.labels[i]) & (ids != anchors.ids[i]) & (own >= least) & (own <= most))
                if len(mine):
                    kept = held.setdefault((zone["length"], int(i)), [0, [], []])
                    kept[0] += len(mine)
                    kept[1].append(ids[mine])
                    kept[2].append(own[mine])
                    if kept[0] > HELD:
                        cut(anchors, int(i), kept)
        rows = []
        for (length, i), own in held.items():
            anchors, ids, scores = sent.value[length], np.concatenate(own[1]), np.concatenate(own[2])
            for number, at in chosen(anchors.windows[i], ids, scores):
                rows.append((np.full(len(at), anchors.places[i], np.int32), np.full(len(at), number, np.int32), ids[at], scores[at]))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names=["anchor", "positive", "vec_id", "score"])

    return negatives


def _top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best of each group, merged in two levels: first the lists of some tasks, then those of all."""
    order = [F.col("score").desc(), F.col("vec_id")]
    branch = found.withColumn("branch", F.col("task") % 32)
    some = branch.withColumn("r", F.row_number().over(Window.partitionBy(*by, "branch").orderBy(*order))).filter(F.col("r") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k).drop("r", "branch", "task")


def mine_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels whose score is low to high per cent of the positive's.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Scores are inner products of the
    vectors with each component as floor(scale * x); higher ones come first, ties by smaller id. Positives are the first
    other rows of the anchor's label, all if there are fewer; for each the first negatives with
    `low * positive <= 100 * negative <= high * positive` are returned, all if fewer, so a positive with a negative score has none.

    Rows with a null id, label or vector, or a null or not finite component, take no part. Rows equal in id, label and
    vector count once; an id with several labels or vectors is so many rows, of which none is a positive or negative of the
    others. Only vectors of equal length are compared; very long vectors make blocks of as many bytes. An empty table
    gives an empty one; other columns take no part, whatever they are called.

    All rows are candidates. The anchors go out in groups of a fixed number of bytes; each group is two passes over the zone
    map, in which each task reads the blocks that may hold a wanted score. A row group of a block is at most 256 vectors.
    """
    spark = vectors.sparkSession
    stage = Stage(spark)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), quantised(F.col(vector_col), scale).alias("v"),
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = stage.write(rows.groupBy("vec_id", "label", "v").agg(F.max("is_anchor").alias("is_anchor")), "labelled-vectors")
    folder = new_path(spark, "llm-blocks")
    zones = stage.write(write_blocks(rows.select("vec_id", "label", "v"), folder), "zone-map")
    n_blocks = zones.count()
    zones = stage.write(zones.repartition(max(1, -(-n_blocks // TASK_BLOCKS)), "file", F.expr("grp div 8")), "zones")

    anchors = rows.filter("is_anchor").select("vec_id", "label", "v")
    size = anchors.agg(F.count("*").alias("n"), F.sum(24 + 8 * F.size("v")).alias("bytes")).first()
    groups = max(1, -(-(size.bytes or 0) // ANCHOR_BYTES))
    anchors = stage.write(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(groups)).cast("int")), "anchors")
    parts: list[DataFrame] = []
    for g in range(groups if size.n else 0):
        own = sorted(anchors.filter(F.col("block") == g).collect(), key=lambda r: (len(r.v), r.vec_id, r.label, r.v))
        by_length: dict[int, list] = {}
        for place, r in enumerate(own):
            by_length.setdefault(len(r.v), []).append((place, r.vec_id, r.label, r.v))
        held = {n: Anchors(*map(list, zip(*some, strict=True)), n) for n, some in by_length.items()}

        def least(found: DataFrame, held=held) -> None:
            """Notes the score of each anchor's last positive so far; as many numbers as anchors of the group."""
            at = {int(p): (a, i) for a in held.values() for i, p in enumerate(a.places)}
            for r in found.filter(F.col("rank") == positives).select("anchor", "score").collect():
                a, i = at[r.anchor]
                a.least[i] = r.score

        first = spark.sparkContext.broadcast(held)
        seeds = zones.mapInArrow(_seeds(first), "anchor int, bound double, file string, grp int, length int")
        by_bound = Window.partitionBy("anchor").orderBy("bound", "file", "grp")
        seeds = seeds.withColumn("r", F.row_number().over(by_bound)).filter(F.col("r") <= SEEDS).groupBy("file", "grp", "length").agg(F.collect_list("anchor").alias("anchors"))
        seeds = stage.write(seeds, "seeds")
        near = seeds.mapInArrow(_positives(first, positives, True), _SCORED).withColumn("task", F.spark_partition_id())
        least(_top(near, ["anchor"], positives))
        first.unpersist()

        second = spark.sparkContext.broadcast(held)
        best = stage.write(zones.mapInArrow(_positives(second, positives, False), _SCORED).withColumn("task", F.spark_partition_id()), "positives")
        best = _top(best, ["anchor"], positives).collect()  # at most `positives` rows for each anchor of the group
        second.unpersist()
        at = {int(p): (a, i) for a in held.values() for i, p in enumerate(a.places)}
        for r in best:
            a, i = at[r.anchor]
            least_score, most_score = -(-low * r.score // 100), high * r.score // 100
            if least_score <= most_score:
                a.windows[i].append((r["rank"], least_score, most_score))
        third = spark.sparkContext.broadcast(held)
        found = stage.write(zones.mapInArrow(_negatives(third, negatives), _MINED).withColumn("task", F.spark_partition_id()), f"negatives-{g}")
        third.unpersist()
        known = spark.createDataFrame([(r.anchor, r["rank"], own[r.anchor].vec_id, r.vec_id, r.score) for r in best], "anchor int, positive int, anchor_id bigint, positive_id bigint, positive_score bigint")
        parts.append(_top(found, ["anchor", "positive"], negatives).join(known, ["anchor", "positive"]))
    stage.release("seeds", "positives", "labelled-vectors", "zone-map", "zones", "anchors")
    stage.delete(folder)
    if not parts:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each hundredth vector, after the labels of each seventh have been shifted."""
    importable(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
