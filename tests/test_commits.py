"""Commits of a whole job, and the tables it stages."""

import os

import pytest
from support import rows
from pyspark.sql import functions as F

from filingloom.sources import commits, snapshots
from filingloom.sources.commits import CommitConflict, commit, manifest, read_mart, run_job, versions
from filingloom.sources.snapshots import stage, work_dir, work_scope


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string")


def staged(spark):
    folder = work_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("stage-")}


def test_a_commit_is_all_tables_or_none(spark, tmp_path, monkeypatch):
    mart = f"file://{tmp_path}/mart"
    assert read_mart(spark, mart) == {} and versions(spark, mart) == []
    assert commit(spark, mart, {"a": frame(spark, (1, "x")), "b": frame(spark, (1, "y"), (2, "z")), "empty": frame(spark)}) == {"a": 1, "b": 2, "empty": 0}
    assert set(read_mart(spark, mart)) == {"a", "b"} and versions(spark, mart) == [1]

    def broken(df, path, write=snapshots.write_snapshot):
        if "/b/" in path:
            raise OSError("no space")
        write(df, path)

    with monkeypatch.context() as m:
        m.setattr(commits, "write_snapshot", broken)
        with pytest.raises(OSError):
            commit(spark, mart, {"a": frame(spark, (5, "new")), "b": frame(spark, (5, "new"))})
    after = read_mart(spark, mart)
    assert versions(spark, mart) == [1] and rows(after["a"]) == [(1, "x")] and rows(after["b"]) == [(1, "y"), (2, "z")]
    assert len(os.listdir(tmp_path / "mart" / "a")) == 1

    commit(spark, mart, {"a": frame(spark, (3, "w"))}, {"b": (frame(spark, (2, "changed")), ["k"])})
    after = read_mart(spark, mart)
    assert rows(after["a"]) == [(1, "x"), (3, "w")] and rows(after["b"]) == [(1, "y"), (2, "changed")]
    assert rows(read_mart(spark, mart, 1)["b"]) == [(1, "y"), (2, "z")], "the former state stays readable"


def test_two_commits_at_a_time(spark, tmp_path, monkeypatch):
    mart = f"file://{tmp_path}/mart"
    commit(spark, mart, {"a": frame(spark, (1, "x"))})
    old = manifest(spark, mart)
    commit(spark, mart, {"a": frame(spark, (2, "y"))})
    monkeypatch.setattr(commits, "manifest", lambda *a: old)
    with pytest.raises(CommitConflict):
        commit(spark, mart, {"a": frame(spark, (3, "z"))})
    monkeypatch.undo()
    assert rows(read_mart(spark, mart)["a"]) == [(1, "x"), (2, "y")]


def test_staged_tables_go_with_their_scope(spark, tmp_path):
    before = staged(spark)
    with pytest.raises(ZeroDivisionError), work_scope(spark):
        stage(frame(spark, (1, "x")), "one")
        assert len(staged(spark) - before) == 1
        1 / 0
    assert staged(spark) == before
    mart = f"file://{tmp_path}/mart"

    def job(sources, known):
        fresh = stage(sources["s"], "fresh")
        new = fresh.join(known["t"], "k", "left_anti") if "t" in known else fresh
        return {"t": stage(new, "new"), "report": fresh, "ledger": spark.createDataFrame([("j", "s", "accepted", 2)], "job string, source string, outcome string, n bigint")}

    source = frame(spark, (1, "x"), (2, "y"))
    assert run_job(spark, mart, job, {"s": source}, {"t"}) == ({"t": 2}, [("j", "s", "accepted", 2)])
    assert run_job(spark, mart, job, {"s": source.withColumn("k", F.col("k") + 1)}, {"t"})[0] == {"t": 1}
    assert rows(read_mart(spark, mart)["t"], "k") == [(1,), (2,), (3,)]
    assert staged(spark) == before
