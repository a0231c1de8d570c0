import pytest
from support import rows

from filingloom.operators import resolve

MASTER = [
    (1, "Solo", "Here", "CA"), (2, "Twin", "Here", "CA"), (3, "Twin", "There", "NV"), (4, "Trio", "Here", "CA"),
    (5, "Trio", "Here", "OR"), (6, "State", "Far", "CA"), (7, "State", "Off", "NV"), (1, "solo ", "Again", "CA"),
]
PROBES = [
    # org_name, filer_id, type, city, state, n -> match rule, id (None: new)
    ("Solo", "10", "FRM", None, None, "name", 1),
    ("twin", "11", "FRM", "HERE", None, "name_place", 2),
    ("TWIN ", "12", "LEM", "there", "NV", "name_place", 3),
    ("Twin", "13", "LEM", "Here", "NV", "new_ambiguous", None),
    ("Trio", None, "LEM", "here", None, "new_ambiguous", None),
    ("Trio", "14", "LEM", "nowhere", "OR", "name_place", 5),
    ("State", "15", "LEM", None, "CA", "name_place", 6),
    ("State", "16", "LEM", None, None, "new_ambiguous", None),
    ("Nobody", "17", "LEM", "Here", "CA", "new", None),
    ("nobody", "18", "FRM", "There", "CA", "new", None),
    ("X", "19", "LEM", "Here", "CA", "placeholder", None),
    ("x", "20", "LEM", "Here", "CA", "placeholder", None),
    ("Cached", "21", "LEM", None, None, "cache", 99),
]
ORDER = ["n"]


@pytest.fixture
def master(spark):
    return spark.createDataFrame(MASTER, "oid bigint, name string, city string, state string")


@pytest.fixture
def probes(spark):
    data = [(*p[:5], i) for i, p in enumerate(PROBES)]
    df = spark.createDataFrame(data, "org_name string, filer_id string, type string, city string, state string, n int")
    return resolve.org_probes(df, ORDER)


@pytest.fixture
def xref(spark):
    return spark.createDataFrame(
        [("CACHED", "21", "LEM", 99)], "org_name string, filer_id string, type string, organization_id bigint"
    )


def test_org_cascade(probes, master, xref):
    resolved, new_orgs = resolve.resolve_orgs(probes, master, ORDER, xref=xref)
    found = {(r.org_name, r.filer_id, r.type): r for r in resolved.collect()}
    assert len(found) == len(PROBES) == resolved.count()
    for name, filer, kind, _, _, rule, oid in PROBES:
        r = found[(name.strip().upper(), filer or "", kind)]
        assert (r.match_rule, r.organization_id if r.organization_id >= 0 else None) == (rule, oid), name
    ids = {k[:2]: r.organization_id for k, r in found.items()}
    assert ids["NOBODY", "17"] == ids["NOBODY", "18"], "one new organisation per unknown name"
    assert ids["X", "19"] != ids["X", "20"], "placeholders are told apart by filer"
    assert found["TRIO", "", "LEM"].n_candidates == 2
    made = rows(new_orgs, "name", "city", "state")
    assert made == sorted([
        ("NOBODY", "HERE", "CA"), ("STATE", None, None), ("TRIO", "HERE", None), ("TWIN", "HERE", "NV"),
        ("X", "HERE", "CA"), ("X", "HERE", "CA"),
    ], key=repr)


def test_first_place_of_a_key_counts(spark, master):
    df = spark.createDataFrame(
        [("Twin", "1", "FRM", "There", None, 2), ("Twin", "1", "FRM", "Here", None, 1)],
        "org_name string, filer_id string, type string, city string, state string, n int",
    )
    resolved, _ = resolve.resolve_orgs(resolve.org_probes(df, ORDER), master, ORDER)
    assert rows(resolved, "organization_id") == [(2,)]


def test_org_by_filer(spark, master):
    df = spark.createDataFrame(
        [("Solo", "1", "A", None, None, 1), ("Other", "1", "B", None, None, 2), ("Known", "2", "A", None, None, 3),
         ("Solo", "", "A", None, None, 4), ("Free", "", "A", None, None, 5)],
        "org_name string, filer_id string, type string, city string, state string, n int",
    )
    bridge = spark.createDataFrame([(77, None, "2"), (None, 5, "1")], "organization_id bigint, person_id bigint, filer_id string")
    resolved, new_orgs = resolve.resolve_orgs(
        resolve.org_probes(df, ORDER), master, ORDER, bridge=bridge, by_filer=True
    )
    found = {(r.org_name, r.filer_id): (r.match_rule, r.organization_id) for r in resolved.collect()}
    assert found["SOLO", "1"] == found["OTHER", "1"] == ("name", 1)
    assert found["KNOWN", "2"] == ("filer", 77)
    assert found["SOLO", ""] == ("name", 1)
    assert found["FREE", ""][0] == "new" and rows(new_orgs, "name") == [("FREE",)]


PEOPLE = [
    (1, "ANN", "QUINCY", "LEE", "A"), (2, "ANN", "QUEEN", "LEE", "A"), (3, "BOB", None, "LEE", "A"),
    (4, "BOB", "T", "LEE", "A"), (5, "CAT", "X", "LEE", "A"), (6, "DAN", "A", "LEE", "TT_Lobbyist"),
    (7, "DAN", "B", "LEE", "A"), (8, "EVE", "A", "LEE", "A"), (9, "EVE", "B", "LEE", "A"), (10, "FAY", "", "LEE", "A"),
]


@pytest.mark.parametrize("first, middle, rule, pid", [
    ("ANN", "QUI", "middle", 1), ("ANN", "QUINCY.", "middle", 1), ("ANN", "Q.", "ambiguous_middle", None),
    ("ANN", "Z", "ambiguous", None), ("BOB", None, "middle", 3), ("CAT", None, "name", 5), ("CAT", "Y", "name", 5),
    ("DAN", None, "preferred", 6), ("EVE", None, "ambiguous", None), ("EVE", ".", "ambiguous_middle", None),
    ("FAY", None, "middle", 10), ("NOB", None, "none", None), ("ANN", "QUINCYX", "ambiguous", None),
])
def test_person_cascade(spark, first, middle, rule, pid):
    master = spark.createDataFrame(PEOPLE, "pid bigint, first string, middle string, last string, source string")
    probes = spark.createDataFrame([(first, middle, "LEE"), (first, middle, "LEE")], "first string, middle string, last string")
    found = rows(resolve.resolve_people(probes, master), "match_rule", "master_pid")
    assert found == [(rule, pid), (rule, pid)]


def test_fill_missing_and_conflicts(spark):
    stored = spark.createDataFrame([(1, "A", None, "L"), (2, None, None, None)], "id int, first string, middle string, last string")
    incoming = spark.createDataFrame(
        [(1, 1, "A", None, "L"), (1, 3, "B", "M3", "L"), (1, 2, "A", "M2", None), (2, 1, None, None, "Z"), (2, 2, "F", None, "Y")],
        "id int, n int, first string, middle string, last string",
    )
    cols = ["first", "middle", "last"]
    filled = resolve.fill_missing(stored, incoming, ["id"], cols, ["n"])
    assert rows(filled) == [(1, "A", "M2", "L"), (2, "F", None, "Z")]
    assert rows(resolve.conflicts(stored, incoming, ["id"], cols)) == sorted([
        (1, "first", "A", "B"), (1, "middle", None, "M3"), (1, "middle", None, "M2"), (1, "last", "L", None),
        (2, "last", None, "Z"), (2, "first", None, "F"), (2, "last", None, "Y"),
    ], key=repr)


def test_match_summary(spark):
    df = spark.createDataFrame([("new",), ("name",), ("new",)], "match_rule string")
    assert rows(resolve.match_summary(df)) == [("name", 1), ("new", 2)]
