"""Connected components of links between integer ids, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import Stage

_EDGES = "u bigint, v bigint"


LINKS = 100_000  # links that a task makes a forest of at a time


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as a forest, LINKS at a time: every id with the smallest id it reaches within them."""
    parent: dict[int, int] = {}
    held = 0

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def stars() -> Iterator[pa.RecordBatch]:
        if rows := [(x, root(x)) for x in list(parent)]:
            u, v = np.array(rows, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])
        parent.clear()

    for whole in batches:
        for at in range(0, whole.num_rows, LINKS):
            batch = whole.slice(at, LINKS)
            if held + batch.num_rows > LINKS:
                yield from stars()
                held = 0
            held += batch.num_rows
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
    yield from stars()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each id that hangs on another hangs on one alone, on which others may hang but which hangs on none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionAll(edges.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.filter("hangs > 1 OR hangs > 0 AND holds > 0").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, stage: Stage, name: str = "stars") -> DataFrame:
    """Ids that reach a smaller one, with the smallest id they reach: columns node and label.

    Links are the two first columns, in any direction, repeated or not. A round hangs the larger neighbours of each id
    on its smallest one, then the smaller ones; the rounds end when all components are stars, after a number that grows
    with the logarithm of the longest path. Only minima per id are gathered; the joins can split an id with many links.
    Before the rounds each task makes a forest of its links, then again in tasks of LINKS; where one holds all, that is the result.
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).filter("u <> v")
    edges = stage.write(edges.mapInArrow(_forest, _EDGES), name)
    tasks = max(1, -(-edges.count() // LINKS))
    forest = edges.coalesce(tasks).mapInArrow(_forest, _EDGES)
    edges = stage.write(forest if tasks == 1 else forest.distinct(), name)
    while tasks > 1 and not _are_stars(edges):
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage.write(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-least")
        large = stage.write(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"{name}-large")
        least = stage.write(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = stage.write(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), name)
    stage.release(f"{name}-least", f"{name}-large")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
