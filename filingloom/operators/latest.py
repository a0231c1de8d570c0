"""Latest amendment of a filing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.functions.text import amendment_no


def _order_column(df: DataFrame, order: str) -> Column:
    return amendment_no(F.col(order)) if dict(df.dtypes)[order] == "string" else F.col(order)


# Bytes of a stored table: beyond the first its maxima may be too many to broadcast; up to the second for each shuffle
# partition they fit a task's hash table, even if every row is a filing of its own.
LARGE, HASHED = 16 << 20, 8 << 20


def _hashes(df: DataFrame) -> bool:
    """Whether the maxima are joined by hash and the rows need not be sorted, by the size of the files they come from."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return LARGE < size <= HASHED * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _all_ties(df: DataFrame, key: list[str]) -> DataFrame:
    """Every row whose `_order` is the highest of its key: the maximum per key, joined back.

    The maximum is partly computed before its shuffle, and the join can split a filing with many tied rows.
    """
    top = df.groupBy(*[F.col(k).alias(f"_top_{k}") for k in key]).agg(F.max("_order").alias("_top"))
    top = top.hint("shuffle_hash") if _hashes(df) else top
    same = [F.col(k).eqNullSafe(F.col(f"_top_{k}")) for k in key]
    return df.join(top, reduce(lambda a, b: a & b, [*same, F.col("_order").eqNullSafe(F.col("_top"))]), "left_semi")


def latest_amendment(
    df: DataFrame,
    key: str | list[str],
    order: str,
    ties: str = "keep",
    tie_break: list[str] | None = None,
    where: Column | None = None,
    rank_scope: str = "form",
) -> DataFrame:
    """Rows of the latest amendment per key; text amendment numbers are ordered as numbers.

    ties="keep" returns every row of the latest amendment; "single" returns one row, chosen by
    `tie_break` and then by all columns. With rank_scope="form" the filter `where` applies before
    the latest amendment is picked, with "filing" after it; the two differ when an amendment
    changes what the filter tests.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if rank_scope not in ("filing", "form"):
        raise ValueError(f"unknown rank_scope: {rank_scope}")
    columns = df.columns
    source = df.filter(where) if where is not None and rank_scope == "form" else df
    source = source.withColumn("_order", _order_column(df, order))
    if ties == "keep":
        latest = _all_ties(source, keys)
    elif ties == "single":
        rest = list(dict.fromkeys([*(tie_break or []), *columns]))
        window = Window.partitionBy(*keys).orderBy(F.col("_order").desc_nulls_last(), *rest)
        latest = source.withColumn("_row", F.row_number().over(window)).filter("_row = 1")
    else:
        raise ValueError(f"unknown ties: {ties}")
    latest = latest.select(*columns)
    return latest.filter(where) if where is not None and rank_scope == "filing" else latest
