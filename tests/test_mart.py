from datetime import date

from support import rows
from pyspark.sql import functions as F

from filingloom.functions import codes
from filingloom.operators import bills, mart, offices, roles


def test_first_wins(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 1, "a"), (2, 5, None), (3, 1, "z")], "k int, n int, v string")
    loaded = spark.createDataFrame([(3,)], "k int")
    assert rows(mart.first_wins(df, ["k"], ["n"], loaded)) == [(1, 1, "a"), (2, 5, None)]
    plan = mart.first_wins(df, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, "rows are dropped before the shuffle"


AGREEMENTS = [
    (1, "a", date(2020, 1, 1), 1), (1, "a", date(2020, 1, 1), 2), (1, "a", date(2020, 1, 1), 2), (1, "a", None, 3),
    (2, "b", date(2020, 1, 1), 4), (2, "b", date(2020, 1, 1), 4), (9, "z", date(2020, 1, 1), 5), (None, "n", date(2020, 1, 1), 6),
    (3, None, date(2020, 1, 1), 7),
]


def test_insert_or_reject(spark):
    df = spark.createDataFrame(AGREEMENTS, "firm int, client string, start date, n int")
    loaded = spark.createDataFrame([(9, "z", date(2020, 1, 1))], "firm int, client string, start date")
    rules = {"no start": F.col("start").isNull(), "no firm": F.col("firm").isNull()}
    accepted, rejected = mart.insert_or_reject(df, rules, ["firm", "client", "start"], ["n"], loaded)
    assert rows(accepted, "firm", "n") == [(1, 1), (2, 4)]
    assert rows(rejected, "firm", "n", "reason", "copies") == sorted([
        (1, 2, "duplicate", 2), (1, 3, "no start", 1), (2, 4, "duplicate", 1), (9, 5, "exists", 1), (None, 6, "no firm", 1),
        (3, 7, "no key", 1),
    ], key=repr)
    assert accepted.count() + rejected.agg(F.sum("copies")).first()[0] == len(AGREEMENTS)


def test_surrogate_keys_are_stable_and_tell_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None)], "x string, y string")
    keyed = df.withColumn("_id", mart.surrogate_key(F.col("x"), F.col("y")))
    ids = {r._id for r in keyed.collect()}
    assert len(ids) == 5 and max(ids) < 0
    assert ids == {r._id for r in keyed.repartition(3).collect()}
    assert mart.key_collisions(keyed, "_id", ["x", "y"]).count() == 0
    assert rows(mart.key_collisions(keyed.withColumn("_id", F.lit(1)), "_id", ["x", "y"])) == [(1, 5)]


def test_lookup_or_create(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "x string, y int")
    stored = spark.createDataFrame([("a", 1, 42)], "x string, y int, _id bigint")
    found = {r.x: r for r in mart.lookup_or_create(df, ["x", "y"], stored).collect()}
    assert found["a"]._id == 42 and not found["a"].is_new
    assert found["b"]._id < 0 and found["b"].is_new


def test_filer_bridge_skips_blank(spark):
    people = spark.createDataFrame([(1, "f"), (1, "f"), (2, ""), (3, None)], "person_id bigint, filer_id string")
    orgs = spark.createDataFrame([(1, "f"), (2, "")], "organization_id bigint, filer_id string")
    assert rows(mart.filer_bridge(people, orgs)) == [(1, None, "f"), (None, 1, "f")]


def test_without_matches_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "x int, y string")
    assert rows(mart.without(df, df.filter("x = 1"), ["x", "y"])) == [(2, "a")]


def test_parties(spark):
    filed = spark.createDataFrame([(1, "R"), (1, "D"), (1, "D"), (2, "D")], "person_id int, party string")
    stored = spark.createDataFrame([(1, "D")], "person_id int, party string")
    assert rows(mart.add_parties(filed, stored)) == [(1, "R"), (2, "D")]
    assert rows(mart.parties_of(filed)) == [(1, ["D", "R"]), (2, ["D"])]


def test_route_and_link(spark):
    df = spark.createDataFrame([(1, "C", "N"), (2, "B", "Y"), (2, "B", "Y"), (3, "G", None)], "id int, kind string, yn string")
    routed = mart.route(df, {"controlled": (F.col("kind") == "C") | (F.col("yn") == "Y"), "general": F.col("kind") == "G"}, ["id"])
    assert rows(routed["controlled"]) == [(1,), (2,)] and rows(routed["general"]) == [(3,)]
    other = spark.createDataFrame([(2, 7), (2, 7), (3, 8)], "id int, activity int")
    assert rows(mart.link(df, other, ["id"], ["id", "activity"])) == [(2, 7), (3, 8)]


def test_code_tables():
    sizes = {t: len(getattr(codes, t)) for t in ("DISTRICT", "PARTY", "OFFICE", "JURISDICTION", "ELECTION")}
    assert sizes == {"DISTRICT": 84, "PARTY": 16, "OFFICE": 145, "JURISDICTION": 7, "ELECTION": 8}
    numbers = {v for v in codes.DISTRICT.values() if v != "N/A"}
    assert numbers == {f"{n:02d}" for n in range(1, 81)}


def test_decode(spark):
    df = spark.createDataFrame([("30013", None), ("30013", "MAYOR"), ("99", ""), ("", None), (None, None), ("0", None)], "c string, t string")
    decoded = mart.decode(df, "c", codes.OFFICE, "label", "t")
    assert sorted(r.label for r in decoded.collect()) == ["ASSEMBLY", "MAYOR", "N/A", "N/A", "N/A", "N/A"]


def test_party_outside_the_list(spark):
    df = spark.createDataFrame([("16001", None), (None, "Whig"), ("16099", ""), ("16001", "green party")], "party_cd string, party string")
    found = rows(offices.decode_party(df), "party", "party_given")
    assert found == [("DEMOCRATIC", "DEMOCRATIC"), ("GREEN PARTY", "GREEN PARTY"), ("N/A", "N/A"), ("N/A", "WHIG")]


def test_same_office_in_two_districts(spark):
    df = spark.createDataFrame(
        [("ASSEMBLY", "N/A", "STATE", "02", "GENERAL", 2020, 2), ("ASSEMBLY", "N/A", "STATE", "01", "GENERAL", 2020, 1),
         ("ASSEMBLY", "N/A", "STATE", "01", "PRIMARY", None, 3), ("MAYOR", "N/A", "CITY", None, "GENERAL", 2020, 4)],
        "title_of_office string, agency string, jurisdiction string, district_number string, election_type string, election_year int, n int",
    )
    out = offices.derive_offices(df, ["n"])
    numbers = {r._id: r.number for r in out["district"].collect()}
    office = {r.title: r for r in out["office"].collect()}
    assert len(office) == 2 and numbers[office["ASSEMBLY"].district_id] == "01" and office["MAYOR"].district_id is None
    assert rows(out["district_conflicts"]) == [("ASSEMBLY", "N/A", "STATE", 2)]
    assert out["election"].count() == 2
    assert offices.derive_offices(df, ["n"], district_in_key=True)["office"].count() == 3
    again = offices.derive_offices(df, ["n"], out["district"], out["office"])
    assert again["district"].count() == again["office"].count() == 0


def test_roles(spark):
    df = spark.createDataFrame([(1, "F", "9", "E"), (2, "F", "9", "E"), (3, "G", None, None)], "id int, firm string, filer string, empl string")
    named = roles.unpivot_roles(
        df, {"FRM": {"org_name": F.col("firm"), "filer_id": F.col("filer")}, "LEM": {"org_name": F.col("empl")}}, ["id"]
    )
    assert named.count() == 6 and named.columns == ["id", "type", "org_name", "filer_id", "city", "state"]
    resolved = spark.createDataFrame(
        [("F", "9", "FRM", 1), ("G", "", "FRM", 2), ("E", "", "LEM", 3)], "org_name string, filer_id string, type string, organization_id bigint"
    )
    both = roles.attach_roles(
        df, resolved, {"firm_id": ("FRM", F.col("firm"), F.col("filer")), "empl_id": ("LEM", F.col("empl"), None)}
    )
    assert rows(both, "id", "firm_id", "empl_id") == [(1, 1, 3), (2, 1, 3), (3, 2, None)]


def test_bills(spark):
    df = spark.createDataFrame([(1, "AB 12, 40;SB 7"), (2, "NONE"), (3, " ACR 1 ;; AB 2,"), (4, None)], "id int, t string")
    mentions = bills.bill_mentions(df, "t", ["id"])
    assert rows(mentions) == [(1, "AB", "12"), (1, "AB", "40"), (1, "SB", "7"), (3, "AB", ""), (3, "AB", "2"), (3, "ACR", "1")]
    known = spark.createDataFrame(
        [("b1", "AB", "12", 2015, "CA"), ("b2", "SB", "7", 2015, "NV"), ("b3", "AB", "40", 2015, "CA"), ("b4", "AB", "40", 2015, "CA")],
        "bid string, type string, number string, session_year int, state string",
    )
    linked = bills.link_bills(mentions.withColumn("ls", F.lit(2015)), known, "ls")
    assert rows(linked.filter("bid IS NOT NULL"), "id", "bid") == [(1, "b1")]
    assert rows(bills.bill_coverage(linked)) == [("AB", 4, 1), ("ACR", 1, 0), ("SB", 1, 0)]
