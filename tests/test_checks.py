from support import rows

from filingloom.operators.checks import check, check_mart
from filingloom.sources.tables import MART, Table, conform, empty_mart

CONTRACT = Table(
    {"id": "bigint", "code": "varchar(3)", "kind": "varchar(9)", "parent": "bigint", "sub": "bigint"},
    ("id",), (("code", "kind"),), ("kind",),
    {("parent",): ("parents", ("_id",)), ("parent", "sub"): ("pairs", ("a", "b"))}, {"kind": ("x", "y")},
)


def test_one_violation_of_every_kind(spark):
    df = spark.createDataFrame(
        [(1, "ab", "x", 1, 1), (1, "abcd", "y", 1, 2), (2, "cd", "z", 2, 1), (3, "ef", None, None, 1), (None, "gh", "x", 1, 1),
         (4, "ab", "x", 1, None), (5, None, "x", 1, 1), (6, None, "x", 1, 1)],
        "id bigint, code string, kind string, parent bigint, sub bigint",
    )
    parents = {
        "parents": spark.createDataFrame([(1,)], "_id bigint"), "pairs": spark.createDataFrame([(1, 1)], "a bigint, b bigint"),
    }
    found = rows(check(df, "t", CONTRACT, parents), "check", "key", "detail", "n")
    assert found == sorted([
        ("primary", "1", "id", 2), ("unique", "ab|x", "code,kind", 2), ("required", "\\N", "id", 1), ("required", "3", "kind", 1),
        ("width", "1", "code", 1), ("domain", "2", "kind", 1), ("parent", "2", "parent->parents", 1),
        ("parent", "1|2", "parent,sub->pairs", 1), ("parent", "2|1", "parent,sub->pairs", 1),
    ], key=repr)


def test_keys_with_separators_and_nulls_are_told_apart(spark):
    contract = Table({"a": "string", "b": "string", "c": "string"}, ("a", "b"), (), ("c",), {}, {})
    df = spark.createDataFrame([("a|b", "c", None), ("a", "b|c", None), ("", None, None), (None, "", None), ("\\\\N", "x", None)], "a string, b string, c string")
    found = [r.key for r in check(df, "t", contract).filter("check = 'required' AND detail = 'c'").collect()]
    assert sorted(found) == sorted(["a\\|b|c", "a|b\\|c", "|\\N", "\\N|", "\\\\\\\\N|x"])


def test_row_checks_read_the_table_once(spark):
    df = spark.createDataFrame([(1, "ab", "x", 1, 1)], "id bigint, code string, kind string, parent bigint, sub bigint")
    one = Table({"id": "bigint", "code": "varchar(3)", "kind": "varchar(9)"}, (), (), ("id", "kind"), {}, {"kind": ("x",)})
    plan = check(df.select("id", "code", "kind"), "t", one)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 1


def test_parents_not_given_are_not_checked(spark):
    df = spark.createDataFrame([(1, "a", "x", 9, 9)], "id bigint, code string, kind string, parent bigint, sub bigint")
    assert check(df, "t", CONTRACT).count() == 0


def test_contracts_are_complete(spark):
    assert len(MART) == 34
    for name, table in MART.items():
        columns = set(table.columns)
        named = {*table.primary, *table.required, *table.domains, *[c for u in table.unique for c in u]}
        assert named <= columns, name
        for cols, (parent, parent_cols) in table.parents.items():
            assert set(cols) <= columns and set(parent_cols) <= set(MART[parent].columns), name
        assert empty_mart(spark, name).columns == list(table.columns)


def test_empty_mart_has_no_violations(spark):
    mart = {t: empty_mart(spark, t) for t in ("person", "lobbyist", "candidate", "running", "election", "office")}
    assert check_mart(mart, MART).count() == 0


def test_conform_fills_columns_nobody_filled(spark):
    df = spark.createDataFrame([(7, "x")], "_id int, first string")
    assert rows(conform(df, "person")) == [(7, None, "x", None, None, None, None)]
