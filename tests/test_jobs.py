"""The jobs on hand-made filings: results, constraints, reruns."""

import pytest
from support import rows
from pyspark.sql import functions as F

from filingloom.operators.checks import check_mart
from filingloom.plans import candidates, committees, contracts, individuals, registrations
from filingloom.sources.snapshots import merge_snapshot, stage
from filingloom.sources.tables import MART, RAW, raw_schema

JAN, MAR, END = "1/1/2015 12:00:00 AM", "3/1/2016 12:00:00 AM", "1/31/2015 12:00:00 AM"


def raw(name, *records):
    return [tuple(r.get(c) for c in RAW[name]) for r in records]


def lobbyist(filing, filer, first, last, org="FIRM ONE", start=JAN, amend="0"):
    return {"filing_id": filing, "amend_id": amend, "form_type": "F615", "filer_id": filer, "entity_cd": "LBY",
            "filer_naml": last, "filer_namf": first, "firm_name": org, "from_date": start, "thru_date": END}


def org(filing, form, filer, kind, name, start=JAN, amend="0", city="Sacramento, CA", activity="AB 1", first=None):
    return {"filing_id": filing, "amend_id": amend, "form_type": form, "filer_id": filer, "entity_cd": kind, "filer_naml": name,
            "filer_namf": first, "firm_city": city, "lby_actvty": activity, "from_date": start, "thru_date": END}


COVERS = [
    lobbyist("100", "L1", "Ann B.", "Lee"), lobbyist("101", "L1", "Ann", "Lee Kim", "Acme Corp", MAR),
    lobbyist("102", "L2", "", "Solo Name"), lobbyist("103", "L3", None, None),
    lobbyist("104", "L4", "Old", "Amend", amend="2"), lobbyist("104", "L4", "New", "Amend", amend="10"),
    org("200", "F625", "F1", "FRM", " Firm One "), org("201", "F635", "E1", "LEM", "ACME CORP", MAR),
    org("202", "F635", "E1", "LEM", "acme corp", MAR, activity="AB 2"),
    org("203", "F625", "F2", "FRM", "Firm Two"),
    org("300", "F645", "I1", "LCO", "Alone", first="Stand "), org("301", "F645", "I2", "FRM", "No First"),
    org("302", "F645", "", "FRM", "Firm One", first=""),
]
REGISTRATIONS = [
    {"filing_id": "400", "amend_id": "0", "form_type": "F604", "entity_cd": "LBY", "filer_id": "L1", "ls_beg_yr": "2015",
     "complet_dt": "9/1/2015 12:00:00 AM"},
    {"filing_id": "401", "amend_id": "0", "form_type": "F604", "entity_cd": "LBY", "filer_id": "L1", "ls_beg_yr": "2015",
     "complet_dt": "12/1/2016 12:00:00 AM"},
    {"filing_id": "402", "amend_id": "0", "form_type": "F604", "entity_cd": "LBY", "filer_id": "L2", "ls_beg_yr": "2013",
     "complet_dt": "12/1/2013 12:00:00 AM"},
    {"filing_id": "500", "amend_id": "0", "form_type": "F601", "entity_cd": "FRM", "filer_id": "F1", "filer_naml": "FIRM ONE", "ls_beg_yr": "2015"},
    {"filing_id": "501", "amend_id": "0", "form_type": "F601", "entity_cd": "FRM", "filer_id": "F1", "filer_naml": "Firm One", "ls_beg_yr": "2015"},
]
PAYMENTS = [
    {"filing_id": "200", "amend_id": "0", "emplr_naml": n, "lby_actvty": f"for {n}"} for n in ("Acme Corp", "Beta", "Gamma", "")
]
CLIENTS = [
    {"filing_id": "501", "amend_id": "0", "cli_naml": "ACME CORP", "eff_date": JAN, "con_period": "2015"},
    {"filing_id": "501", "amend_id": "0", "cli_naml": "ACME CORP", "eff_date": JAN, "con_period": "2016"},
    {"filing_id": "501", "amend_id": "0", "cli_naml": "Beta", "eff_date": "soon", "con_period": "2015"},
    {"filing_id": "501", "amend_id": "0", "cli_naml": "Gamma", "eff_date": JAN, "con_period": "2015"},
    {"filing_id": "501", "amend_id": "0", "cli_naml": "", "eff_date": JAN, "con_period": "2015"},
    {"filing_id": "500", "amend_id": "0", "cli_naml": "Acme Corp", "eff_date": MAR, "con_period": "older filing"},
]
SUBCONTRACTS = [
    {"filing_id": "200", "amend_id": "0", "firm_name": "firm two", "firm_city": "Reno", "firm_st": "NV", "subj_naml": "gamma"},
    {"filing_id": "200", "amend_id": "0", "firm_name": "Firm Three", "subj_naml": "Beta"},
]


def intention(filing, filer, first, last, **given):
    return {"filing_id": filing, "amend_id": "0", "filer_id": filer, "form_type": "F501", "cand_naml": last, "cand_namf": first,
            "office_cd": "30013", "juris_cd": "40502", "yr_of_elec": "2016", "elec_type": "3002", "party_cd": "16001", **given}


INTENTIONS = [
    intention("600", "C1", "Dan", "Fox Jr.", dist_no="02", committee_id="K1"),
    intention("601", "C1", "Dan", "Fox", dist_no="01", party="Green Party", yr_of_elec="2018", committee_id="K2"),
    intention("602", "C2", "Eve", "Hill", district_cd="17001", party_cd="99999", elec_type="9"),
    intention("603", "C3", None, None), intention("604", "C4", "Gus", "May", yr_of_elec=""),
    intention("605", "C5", "Form", "Two", form_type="F502"),
]


def statement(filing, filer, name, kind, **given):
    return {"filing_id": filing, "amend_id": "0", "form_type": "F410", "filer_id": filer, "entity_cd": "CTL", "filer_naml": name,
            "city": "Davis", "st": "CA", "cmtte_type": kind, "control_yn": "N", **given}


BALLOT = {"bal_name": "Roads", "bal_juris": "STATE", "sup_opp_cd": "s"}
STATEMENTS = [
    statement("700", " K1 ", "Friends of Dan", "C"), statement("701", "K2", "X", "G", control_yn="Y"),
    statement("702", "K3", "X", "B", bal_num="13", **BALLOT), statement("703", "K4", "Roads PAC", "B", bal_num="12345", **BALLOT),
    statement("704", "K5", "Money PAC", "P"), statement("705", "K6", "No Covers", "P"),
    statement("706", "K7", "Other PAC", "B", bal_num="14", bal_name="Dams", sup_opp_cd="O"),
]
CAMPAIGNS = [{"filer_id": k, "from_date": d} for k in ("K1", "K2", "K3", "K4", "K5", "K7") for d in (JAN, JAN, "1/1/2017 12:00:00 AM")]


@pytest.fixture(scope="module")
def sources(spark):
    made = {
        "lobby_disclosure": COVERS, "registration": REGISTRATIONS, "payment_line": PAYMENTS, "employer_line": CLIENTS,
        "subcontract_line": SUBCONTRACTS, "candidate_intention": INTENTIONS, "committee_statement": STATEMENTS,
        "campaign_cover": CAMPAIGNS,
    }
    frames = {n: spark.createDataFrame(raw(n, *records), raw_schema(n)) for n, records in made.items()}
    frames["master_org"] = spark.createDataFrame(
        [(1, "Firm One", "SACRAMENTO", "CA"), (2, "Acme Corp", "RENO", "NV"), (3, "ACME CORP", "SACRAMENTO", "CA")],
        "oid bigint, name string, city string, state string",
    )
    frames["master_person"] = spark.createDataFrame(
        [(11, "Ann", "Betty", "Lee", "A"), (12, "Dan", None, "Fox", "A")], "pid bigint, first string, middle string, last string, source string"
    )
    return frames


KEYS = {name: list(t.primary or t.columns) for name, t in MART.items()}
KEYS["org_xref"] = ["org_name", "filer_id", "type"]


def load(mart, out):
    """The next snapshot: new rows added, each table written before it is read again."""
    for name, df in out.items():
        if name in KEYS:
            mart[name] = stage(merge_snapshot(mart.get(name), df, KEYS[name]), name)
    return mart


JOBS = {
    "registrations": registrations.run_registrations, "contracts": contracts.run_contracts,
    "subcontracts": contracts.run_subcontracts, "individuals": individuals.run_individuals,
    "candidates": candidates.run_candidates, "committees": committees.run_committees,
}


@pytest.fixture(scope="module")
def first_run(sources):
    """All jobs in order, each on the mart the earlier ones left."""
    mart, outs = {}, {}
    for name, job in JOBS.items():
        outs[name] = job(sources, mart)
        load(mart, outs[name])
    return mart, outs


def test_registrations(first_run):
    out = first_run[1]["registrations"]
    people = {r.first: r for r in out["person"].collect()}
    assert set(people) == {"ANN", "SOLO", "NEW"}
    assert (people["ANN"].middle, people["ANN"].last, people["ANN"].master_pid) == ("B.", "LEE", 11)
    assert people["SOLO"].last == "SOLO NAME"
    assert rows(out["permanent_employment"], "lobbying_firm_id", "legislative_session") == [(1, 2015)] * 3
    assert {str(r.ethics_completion) for r in out["permanent_employment"].collect()} == {"2016-12-01", "None"}
    assert out["direct_employment"].count() == 1 and out["employed_lobbying"].count() == 2
    assert rows(out["activity"], "filing_id", "activity") == [(201, "AB 1"), (202, "AB 2")]
    assert rows(out["conflicts"], "field", "stored", "incoming") == [("last", "LEE", "LEE KIM"), ("middle", "B.", None)]
    assert rows(out["rejected"], "reason") == [("no name",)]
    assert rows(out["org_matches"], "org_name", "match_rule", "organization_id") == [("ACME CORP", "name_place", 3), ("FIRM ONE", "name", 1)]
    assert rows(out["lobbyist_employer"]) == [(3,)] and rows(out["lobbying_firm"]) == [(1,)]


def test_contracts(first_run):
    out = first_run[1]["contracts"]
    assert rows(out["contract"], "lobbying_firm_id", "period_of_contract", "601_filing_id") == [(1, "2015", 501)]
    assert rows(out["rejected"], "period_of_contract", "reason") == [("2016", "duplicate")]
    assert out["contracted_lobbying"].count() == 1
    assert rows(out["activity"], "activity", "filing_id") == [("for Acme Corp", 200)]
    found = {r.org_name: r.match_rule for r in out["org_matches"].collect()}
    assert found["FIRM ONE"] == "cache", "resolved by the job before"


def test_subcontracts(first_run):
    out = first_run[1]["subcontracts"]
    assert out["subcontract"].count() == 1 and out["subcontracted_lobbying"].count() == 1
    assert rows(out["org_matches"], "org_name", "type", "match_rule") == [
        ("FIRM ONE", "FRM", "cache"), ("FIRM TWO", "SFRM", "new"), ("GAMMA", "LEM", "new")]
    assert rows(out["organizations"], "name", "city", "state") == [("FIRM TWO", "RENO", "NV"), ("GAMMA", None, None)]


def test_individuals(first_run):
    out = first_run[1]["individuals"]
    assert rows(out["org_matches"], "org_name", "type", "match_rule") == [("FIRM ONE", "FRM", "name"), ("STAND ALONE", "LCO", "new")]
    assert out["individual_lobbying"].count() == 2
    assert rows(out["rejected"], "reason") == [("no name",)]
    assert out["filer_id"].filter("filer_id = ''").count() == 0


def test_candidates(first_run):
    out = first_run[1]["candidates"]
    people = {r.first: r for r in out["person"].collect()}
    assert set(people) == {"DAN", "EVE", "GUS"}
    assert (people["DAN"].suffix, people["DAN"].last, people["DAN"].master_pid) == ("JR.", "FOX", 12)
    dan = people["DAN"]._id
    assert rows(out["candidate"].filter(F.col("person_id") == dan), "party") == [("DEMOCRATIC",), ("GREEN PARTY",)]
    assert rows(out["candidate"].filter(F.col("person_id") == people["EVE"]._id), "party") == [("N/A",)]
    assert rows(out["running"], "election_type", "election_year", "501_filing_id") == [
        ("N/A", 2016, 602), ("PRIMARY", 2016, 600), ("PRIMARY", 2018, 601)]
    assert rows(out["office"], "title", "jurisdiction") == [("ASSEMBLY", "STATE")]
    assert rows(out["district"], "number") == [("01",), ("02",)]
    assert rows(out["district_conflicts"], "n_districts") == [(2,)]
    assert rows(out["rejected"], "reason") == [("no election year",), ("no name",)]


def test_committees(first_run):
    mart, out = first_run[0], first_run[1]["committees"]
    assert out["committee"].count() == 6
    matches = {r.filer_id: r for r in out["org_matches"].collect()}
    assert matches["K2"].match_rule == matches["K3"].match_rule == "placeholder"
    assert matches["K2"].organization_id != matches["K3"].organization_id
    assert rows(out["general_committee"]) == [(matches["K2"].organization_id,)]
    assert rows(out["independent_committee"]) == [(matches["K5"].organization_id,)]
    assert rows(out["ballot_committee"]) == [(matches["K3"].organization_id,)]
    assert rows(out["ballot"]) == [("13", 2015, "Roads", "STATE"), ("13", 2017, "Roads", "STATE")]
    assert rows(out["ballot_support"], "legislative_session", "position") == [(2015, True), (2017, True)]
    dan = mart["person"].filter("first = 'DAN'").first()._id
    assert {r.candidate_id for r in out["controlled_committee"].collect()} == {dan}
    assert out["controlled_committee"].count() == 2
    assert {r._id for r in out["committee_candidates"].collect()} == {dan}


def test_candidate_not_loaded_is_rejected(sources):
    person = candidates.run_candidates({**sources, "candidate_intention": sources["candidate_intention"].filter("filing_id = '602'")})
    mart = load({}, person)
    out = committees.run_committees(sources, mart)
    assert out["controlled_committee"].count() == 0
    assert rows(out["rejected"], "committee_filer", "reason") == [("K1", "candidate not loaded"), ("K2", "candidate not loaded")]


def test_no_constraint_is_broken(first_run):
    assert rows(check_mart({n: d for n, d in first_run[0].items() if n in MART}, MART)) == []


def test_second_run_adds_nothing(sources, first_run):
    mart = dict(first_run[0])
    for name, job in JOBS.items():
        out = job(sources, mart)
        for table, df in out.items():
            if table in KEYS:
                assert df.count() == 0, (name, table)


def test_one_more_filing_adds_only_itself(spark, sources, first_run):
    mart = dict(first_run[0])
    more = raw("lobby_disclosure", lobbyist("150", "L9", "Zoe", "Ward"), lobbyist("151", "L1", "Ann", "Lee", "FIRM TWO"))
    grown = {**sources, "lobby_disclosure": sources["lobby_disclosure"].unionByName(spark.createDataFrame(more, raw_schema("lobby_disclosure")))}
    out = registrations.run_registrations(grown, mart)
    assert rows(out["person"], "first") == [("ZOE",)]
    assert rows(out["lobbyist"], "person_id") == rows(out["person"], "_id")
    ann = mart["person"].filter("first = 'ANN'").first()._id
    zoe = out["person"].first()._id
    assert {r.lobbyist_id for r in out["permanent_employment"].collect()} == {ann, zoe}
    assert out["direct_employment"].count() == out["activity"].count() == out["employed_lobbying"].count() == 0


def test_missing_name_of_a_stored_person_is_filled(spark, sources):
    """A stored null is filled by a later filing and reported as an update; nothing else changes."""
    mart = {
        "person": spark.createDataFrame([(5, None, "ANN", None, "LEE", None, None)], MART["person"].schema()),
        "filer_id": spark.createDataFrame([(None, 5, "L1")], MART["filer_id"].schema()),
    }
    out = registrations.run_registrations(sources, mart)
    assert rows(out["person_updates"], "_id", "first", "middle", "last") == [(5, "ANN", "B.", "LEE")]
    assert "ANN" not in {r.first for r in out["person"].collect()}
    assert 5 in {r.lobbyist_id for r in out["permanent_employment"].collect()}
