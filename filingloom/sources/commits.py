"""One commit for all tables of a job.

A mart folder has a folder per table, with a part for each commit that added rows, and numbered manifests. A manifest names
the parts of all tables that make up one state of the mart; it is written last, under a name of its own, and readers use the
newest one. So a job that stops half-way leaves parts that nobody reads, and the former state.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filingloom.sources.snapshots import delete, merge_snapshot, work_scope, write_snapshot

Frames = dict[str, DataFrame]
MANIFEST = "manifest-{:08d}.json"


class CommitConflict(RuntimeError):
    """Someone else has committed since the mart was read."""


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all commits, in order."""
    _, fs = _files(spark, folder)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest-*.json"))
    return sorted(int(f.getPath().getName()[9:-5]) for f in found or [])


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict:
    """The manifest of a commit, by default the newest; an empty one, number 0, if there is none."""
    known = versions(spark, folder)
    if not known:
        return {"version": 0, "tables": {}}
    path, fs = _files(spark, f"{folder}/{MANIFEST.format(version or known[-1])}")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, folder: str, state: dict) -> None:
    """Write the manifest beside its place and move it there; a place that is taken is someone else's commit."""
    target, fs = _files(spark, f"{folder}/{MANIFEST.format(state['version'])}")
    written, _ = _files(spark, f"{folder}/.writing-{uuid.uuid4().hex}")
    stream = fs.create(written, False)
    stream.writeBytes(json.dumps(state, indent=1))
    stream.close()
    if fs.exists(target) or not fs.rename(written, target):
        fs.delete(written, False)
        raise CommitConflict(f"{folder}: commit {state['version']} exists")


def read_mart(spark: SparkSession, folder: str, version: int | None = None) -> Frames:
    """All tables of a commit, by default the newest."""
    tables = manifest(spark, folder, version)["tables"]
    return {
        name: spark.read.schema(StructType.fromJson(t["schema"])).parquet(*[f"{folder}/{p}" for p in t["parts"]])
        for name, t in tables.items()
    }


def commit(spark: SparkSession, folder: str, added: Frames, changed: dict[str, tuple[DataFrame, list[str]]] | None = None) -> dict[str, int]:
    """Add rows to tables, replace changed rows by their key, and publish all of it as one state; the number of rows written.

    A table to which nothing was ever added is in no manifest. Tables keep the columns of their first part.
    """
    state = manifest(spark, folder)
    tables, counts, made = dict(state["tables"]), {}, []
    before = read_mart(spark, folder)

    def write(name: str, df: DataFrame) -> str | None:
        part, seen = f"{name}/{uuid.uuid4().hex}", Observation()
        made.append(part)
        write_snapshot(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{folder}/{part}")
        counts[name] = counts.get(name, 0) + seen.get["n"]
        return part if seen.get["n"] else None

    try:
        for name, df in added.items():
            df = df.select(*before[name].columns) if name in before else df
            if part := write(name, df):
                old = tables.get(name, {"schema": df.schema.jsonValue(), "parts": []})
                tables[name] = {**old, "parts": [*old["parts"], part]}
            else:
                delete(spark, f"{folder}/{made.pop()}")
        for name, (rows, key) in (changed or {}).items():
            if name in before and (part := write(name, merge_snapshot(before[name], rows.select(*before[name].columns), key))):
                new = [p for p in tables[name]["parts"] if p not in before_parts(state, name)]
                tables[name] = {**tables[name], "parts": [part, *new]}
        _publish(spark, folder, {"version": state["version"] + 1, "tables": tables})
    except BaseException:
        for part in made:
            delete(spark, f"{folder}/{part}")
        raise
    return counts


def before_parts(state: dict, name: str) -> list[str]:
    return state["tables"].get(name, {}).get("parts", [])


def run_job(spark: SparkSession, folder: str, job: Callable[[Frames, Frames], Frames], sources: Frames, tables: set[str],
            updates: dict[str, tuple[str, list[str]]] | None = None) -> tuple[dict[str, int], list]:
    """Run a job on the newest state of a mart and commit the tables it fills; the rows added, and the lines of its ledger.

    `tables` are those of the job's results that belong to the mart; `updates` maps a result with changed rows to its table
    and key. Whatever the job staged is deleted, also when it fails; the mart then stays as it was.
    """
    with work_scope(spark):
        out = job(sources, read_mart(spark, folder))
        changed = {table: (out[name], key) for name, (table, key) in (updates or {}).items() if name in out}
        counts = commit(spark, folder, {t: df for t, df in out.items() if t in tables}, changed)
        account = [tuple(r) for r in out["ledger"].collect()] if "ledger" in out else []
    return counts, account
