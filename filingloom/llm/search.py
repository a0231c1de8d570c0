"""Exact top-k search by inner product: tiles of a matrix product, a selection in each tile, and a tree of merges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.llm.common import Stage, importable

QUERY_BYTES = 16 << 20  # query vectors sent to every task at a time
TILE_BYTES = 16 << 20  # scores held at a time: one tile of candidates by all queries of a block
EXACT = 2.0**53  # whole numbers up to here are exact in a float's product and sum
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def quantised(vector: Column, scale: int = 1024) -> Column:
    """Each component as floor(scale * x); null if the vector or any component is null or not finite."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    return F.when(vector.isNotNull() & ~F.exists(vector, bad), whole)


def _merge(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each row: highest score first, then smallest id; an id counts once, with its best score."""
    order = np.lexsort((~scores, ids, row))
    row, ids, scores = row[order], ids[order], scores[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
    row, ids, scores = row[new], ids[new], scores[new]
    order = np.lexsort((ids, ~scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[best], ids[best], scores[best]


class _Lists:
    """The best entries so far of all queries of one length; tiles of candidates come one after the other."""

    def __init__(self, query_ids: np.ndarray, matrix: np.ndarray, k: int) -> None:
        self.query_ids, self.matrix, self.k = query_ids, matrix, k
        self.floats = matrix.astype(float)
        self.largest = float(np.abs(self.floats).max(initial=0.0))
        self.tile = max(1, TILE_BYTES // (8 * len(query_ids)))
        self.row, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _product(self, tile: np.ndarray) -> np.ndarray:
        """Exact whole inner products; those beyond 64 bits are held at the largest or smallest number."""
        if tile.shape[1] == 0:
            return np.zeros((len(self.matrix), len(tile)), np.int64)
        floats = tile.astype(float)
        if self.largest * float(np.abs(floats).max()) * tile.shape[1] < EXACT:
            return (self.floats @ floats.T).astype(np.int64)
        exact = self.matrix.astype(object) @ tile.astype(object).T
        return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)

    def add(self, ids: np.ndarray, tile: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, start = np.unique(ids[order], return_index=True)
        scores = self._product(tile[order])
        if len(start) < scores.shape[1]:  # an id with several rows has its best score
            scores = np.maximum.reduceat(scores, start, axis=1)
        # what a full list holds last; better entries only are looked at
        n, last = np.bincount(self.row, minlength=len(self.matrix)), np.flatnonzero(np.diff(self.row, append=-1))
        full = n >= self.k
        least, least_id = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        least[self.row[last]], least_id[self.row[last]] = self.scores[last], self.ids[last]
        better = (scores > least[:, None]) | ((scores == least[:, None]) & (ids < least_id[:, None])) | ~full[:, None]
        some = np.flatnonzero(better.any(axis=1))
        scores, better = scores[some], better[some]
        if len(ids) > self.k + 1 and len(some):  # one more than k, as the query itself may be among them
            at = len(ids) - self.k - 1
            better &= scores >= np.partition(scores, at, axis=1)[:, at, None]
        better &= ids != self.query_ids[some, None]
        r, c = np.nonzero(better)
        if len(r):
            joined = [np.concatenate(x) for x in ((self.row, some[r]), (self.ids, ids[c]), (self.scores, scores[r, c]))]
            self.row, self.ids, self.scores = _merge(*joined, self.k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row that is a query, the k other rows with the highest inner product: query_id, rank, vec_id, score.

    Ties go to the smaller id. All rows are candidates but those with the query's id. Vectors that are null, or hold a null
    or a component that is not finite, take no part; a row with a null id neither. Only vectors of equal length are
    compared. Rows with one id and one vector count once; an id with several vectors has its best score with each query
    vector. Fewer than k candidates: all of them. An empty table, or one without queries, gives no rows. Vectors may be of any
    length that fits a block. Other columns are not read, whatever their names.

    The queries go out in blocks of a fixed number of bytes; each block is a pass over all candidates, in which every task
    keeps k rows for each query. A tile has as many candidates as give a fixed number of bytes of scores, and its entries are
    chosen for all queries at once. The lists of the tasks are merged in two levels, so no task gathers all lists of a query.
    """
    spark = vectors.sparkSession
    stage = Stage(spark)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = stage.write(rows.filter("vec_id IS NOT NULL AND v IS NOT NULL"), "vectors")
    queries = rows.filter("is_query").select("vec_id", "v").distinct()
    size = queries.agg(F.count("*").alias("n"), F.sum(16 + 8 * F.size("v")).alias("bytes")).first()
    blocks = max(1, -(-(size.bytes or 0) // QUERY_BYTES))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    queries = stage.write(queries.withColumn("block", block), "queries")
    parts: list[DataFrame] = []
    for b in range(blocks if size.n else 0):
        own = queries.filter(F.col("block") == b).collect()
        by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in {len(q.v) for q in own}:
            some = [q for q in own if len(q.v) == length]
            by_length[length] = (np.array([q.vec_id for q in some], np.int64), np.array([q.v for q in some], np.int64).reshape(len(some), length))
        sent = spark.sparkContext.broadcast(by_length)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            kept = {n: _Lists(ids, matrix, k) for n, (ids, matrix) in sent.value.items()}
            for batch in batches:
                ids, lists = batch.column(0).to_numpy(), batch.column(1)
                lengths = lists.value_lengths().to_numpy()
                for n, best in kept.items():
                    at = np.flatnonzero(lengths == n)
                    for cut in range(0, len(at), best.tile):
                        own = at[cut : cut + best.tile]
                        best.add(ids[own], lists.take(pa.array(own)).flatten().to_numpy().reshape(len(own), n))
            for best in kept.values():
                if len(best.row):
                    yield pa.RecordBatch.from_arrays([pa.array(best.query_ids[best.row]), pa.array(best.ids), pa.array(best.scores)], names=["query_id", "vec_id", "score"])

        parts.append(stage.write(rows.select("vec_id", "v").mapInArrow(search, _FOUND).withColumn("task", F.spark_partition_id()), f"found-{b}"))
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    best = found.groupBy("query_id", F.expr("task % 32").alias("branch"), "vec_id").agg(F.max("score").alias("score"))
    order = [F.col("score").desc(), F.col("vec_id")]
    branch = Window.partitionBy("query_id", "branch").orderBy(*order)
    level = best.withColumn("r", F.row_number().over(branch)).filter(F.col("r") <= k).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    top = level.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of each hundredth vector."""
    importable(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 100 == 0)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
