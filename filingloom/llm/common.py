"""Helpers shared by the operators: input tables, staged tables that can be released, free column names."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

from filingloom.sources.snapshots import new_path, read_snapshot, write_snapshot

ASCII_SPACE = b" \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def importable(spark: SparkSession) -> None:
    """Let Spark send this package to the Python workers, which may not have it on their path; once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp()
        kept = shutil.copytree(package, os.path.join(folder, "root", os.path.basename(package)), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "package"), "zip", os.path.dirname(kept)))
        _SHIPPED.add(app)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class Stage:
    """Tables written to the shared folder, each read back by the next step and deleted when no longer read.

    A written table cuts the lineage: a lost executor costs the tasks of the current step only.
    """

    def __init__(self, spark: SparkSession) -> None:
        importable(spark)
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write under a name and read back; an earlier table of that name is released after the write."""
        path, old = new_path(self.spark, f"llm-{name}"), self.paths.get(name)
        write_snapshot(df, path)
        self.paths[name] = path
        if old:
            self.delete(old)
        return read_snapshot(self.spark, path, df.schema)

    def release(self, *names: str) -> None:
        for name in names:
            if path := self.paths.pop(name, None):
                self.delete(path)

    def delete(self, path: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def free_name(df: DataFrame, name: str) -> str:
    """A column name the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
