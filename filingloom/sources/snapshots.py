"""Tables written and read back: mart snapshots, staged intermediate tables, JSON side files."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Folders made for local sessions that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir; a local one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="filingloom-")
    return _LOCAL_DIRS[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a table once to a new path; an existing path is an error, never overwritten."""
    df.write.mode("errorifexists").parquet(path)


def read_snapshot(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


# The staged tables of the innermost work scope; none outside of one.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted when the block ends, whether it succeeds or not.

    What the block is to leave must have been written elsewhere before it ends.
    """
    owned: list[str] = []
    token = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in owned:
            delete(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that feeds many outputs to the shared folder and read it back.

    Cuts the lineage, so losing an executor later does not repeat the work before this point.
    """
    path = new_path(df.sparkSession, f"stage-{name}")
    if (owned := _OWNED.get()) is not None:
        owned.append(path)
    write_snapshot(df, path)
    return read_snapshot(df.sparkSession, path, df.schema)


def unstage(df: DataFrame) -> None:
    """Delete the table behind a frame that came from `stage` and is no longer read."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def merge_snapshot(existing: DataFrame | None, changed: DataFrame, key: list[str]) -> DataFrame:
    """The next snapshot of a table: changed rows replace existing rows of the same key."""
    if existing is None:
        return changed
    return existing.join(changed.select(*key), key, "left_anti").unionByName(changed)


def write_json(df: DataFrame, path: str) -> None:
    """Write a JSON side file, one object per line and null fields kept."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Read a JSON side file with a declared schema; multi_line reads one array of objects."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


# The reference table of organisations resolved so far, an input and an output of every job.
XREF_SCHEMA = "org_name string, filer_id string, type string, organization_id bigint"


def empty_xref(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], XREF_SCHEMA)


def read_xref(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(XREF_SCHEMA).parquet(path)
