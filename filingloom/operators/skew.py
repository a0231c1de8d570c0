"""A many-to-many join that stays spread out when one key holds a large share of the rows.

Lookups with one row per key are plain joins: their lookup side is aggregated, and adaptive execution splits a
hot key of the other side. Where both sides may have many rows of a key, a sketch of fixed size finds the keys that hold
a large share of the left rows, and only their rows are dealt to pieces. All other rows move once. The plan is the same
whether there are such keys or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 64  # a key is hot when it holds more than one in so many left rows, and no piece of it holds more than that
GROUPS = 16  # sketches side by side, each of the keys whose hash falls to it
TRACKED = 512  # keys a sketch keeps count of; a count is off by less than one in 384 of the rows


def hot_keys(df: DataFrame, on: list[str], pieces: int = PIECES) -> DataFrame:
    """The hash of each key that holds more than one in `pieces` rows, as `_key`, and the pieces it is dealt to, as `_pieces`.

    Reads the key columns once. There are fewer than `pieces` such keys, whatever the input; their counts are estimates, so a
    key near the boundary may be in or out. Keys with a null meet nothing and are left out. The list is read now, so both
    sides of a join, and tasks that run again, see the same one.
    """
    keyed = df.dropna(subset=on).select(F.xxhash64(*on).alias("_key"))
    top = F.expr(f"approx_top_k(_key, {pieces}, {max(TRACKED, 8 * pieces)})").alias("top")
    seen = keyed.groupBy(F.pmod("_key", F.lit(GROUPS)).alias("g")).agg(F.count(F.lit(1)).alias("n"), top).collect()
    n = sum(s.n for s in seen)
    found = [(k.item, -(-k["count"] * pieces // n)) for s in seen for k in s.top if k["count"] * pieces > n]
    return df.sparkSession.createDataFrame(found, "_key bigint, _pieces int")


def skew_join(left: DataFrame, right: DataFrame, on: list[str], pieces: int = PIECES) -> DataFrame:
    """Inner equi join in which a hot key's left rows are dealt to pieces, and its right rows repeated for each of them.

    The left side is read twice, once for its keys only, so it should come from a table. All hot keys together have fewer
    than 2 * `pieces` pieces, which bounds the repetition. A row's piece follows from its content, never from a random
    number or its place, so a lost task can run again. Null keys match nothing.
    """
    hot = F.broadcast(hot_keys(left, on, pieces))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(*on)).join(hot, "_key", "left").withColumn("_pieces", F.coalesce("_pieces", F.lit(1))).drop("_key")

    content = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    piece = F.when(F.col("_pieces") > 1, F.pmod(content, F.col("_pieces")).cast("int")).otherwise(F.lit(0))
    dealt = marked(left).withColumn("_piece", piece).drop("_pieces")
    repeated = marked(right).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")
    return dealt.join(repeated, [*on, "_piece"]).drop("_piece")
