import json

import pytest
from support import rows

from filingloom.sources import snapshots
from filingloom.sources.tables import RAW, raw_schema, read_master, read_raw


def test_delimited_dump_with_upper_case_header(spark, tmp_path):
    path = tmp_path / "covers.tsv"
    path.write_text("EXTRA\tFROM_DATE\tFILER_ID\n1\t1/1/2015 12:00:00 AM\t77\n2\t\t78\n")
    df = read_raw(spark, "campaign_cover", str(path), "csv")
    assert df.columns == list(RAW["campaign_cover"])
    assert rows(df) == [("77", "1/1/2015 12:00:00 AM"), ("78", None)]


def test_parquet_by_name_and_pruned(spark, tmp_path):
    path = str(tmp_path / "reg")
    spark.createDataFrame([("F1", "3", "x")], "form_type string, filing_id string, unused string").write.parquet(path)
    df = read_raw(spark, "registration", path)
    assert df.schema == raw_schema("registration")
    assert rows(df, "filing_id", "form_type", "amend_id") == [("3", "F1", None)]
    plan = df.filter("form_type = 'F1'").select("filing_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<filing_id:string,form_type:string>" in plan and "EqualTo(form_type,F1)" in plan


def test_master(spark, tmp_path):
    path = str(tmp_path / "orgs")
    spark.createDataFrame([(1, "A", "B", "C")], "oid bigint, name string, city string, state string").write.parquet(path)
    assert rows(read_master(spark, "master_org", path)) == [(1, "A", "B", "C")]


def test_snapshots_are_never_overwritten(spark, tmp_path):
    path, df = str(tmp_path / "snap"), spark.createDataFrame([(1, "a")], "id int, v string")
    snapshots.write_snapshot(df, path)
    assert rows(snapshots.read_snapshot(spark, path, df.schema)) == [(1, "a")]
    with pytest.raises(Exception, match="(?i)already exists"):
        snapshots.write_snapshot(df, path)


def test_next_snapshot(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    assert rows(snapshots.merge_snapshot(old, new, ["id"])) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(snapshots.merge_snapshot(None, new, ["id"])) == [(2, "c"), (3, "d")]


def test_json_side_files(spark, tmp_path):
    people = spark.createDataFrame([(1, "A", None), (2, None, "B")], "_id bigint, first string, last string")
    path = str(tmp_path / "json")
    snapshots.write_json(people, path)
    assert rows(snapshots.read_json(spark, path, people.schema)) == rows(people)
    array = tmp_path / "array.json"
    array.write_text(json.dumps([{"_id": 1, "first": "A", "last": None}, {"_id": 2, "first": None, "last": "B"}], indent=4))
    assert rows(snapshots.read_json(spark, str(array), people.schema, multi_line=True)) == rows(people)


def test_staged_tables_go_to_the_folder_the_session_names(spark):
    staged = snapshots.stage(spark.range(3).toDF("id"), "three")
    assert staged.count() == 3
    assert all(snapshots.work_dir(spark) in f for f in staged.inputFiles())


def test_own_folder_only_where_none_is_named_and_only_locally():
    class Context:
        applicationId, master = "app-x", "local[2]"

    class Session:
        sparkContext, named = Context, None

        @property
        def conf(self):
            return {"spark.checkpoint.dir": self.named} if self.named else {}

    session = Session()
    made = snapshots.work_dir(session)
    assert made == snapshots.work_dir(session)
    session.named = "hdfs://shared/folder/"
    assert snapshots.work_dir(session) == "hdfs://shared/folder"
    session.named, Context.master = None, "yarn"
    with pytest.raises(ValueError):
        snapshots.work_dir(session)


def test_xref_round_trip(spark, tmp_path):
    path, df = str(tmp_path / "xref"), spark.createDataFrame([("A", "1", "FRM", -5)], snapshots.XREF_SCHEMA)
    snapshots.write_snapshot(df, path)
    assert rows(snapshots.read_xref(spark, path)) == rows(df)
    assert snapshots.empty_xref(spark).count() == 0
