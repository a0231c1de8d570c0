"""What the jobs count, write and leave behind: no more than the result needs."""

import os

import pytest
from support import rows
from pyspark.sql import functions as F

from filingloom import catalog
from filingloom.functions.text import amendment_no
from filingloom.operators import latest
from filingloom.operators.ledger import Ledger
from filingloom.plans import candidates, committees, contracts, individuals, registrations
from filingloom.sources.snapshots import stage, work_dir
from filingloom.sources.tables import MART, RAW, raw_schema

JAN = "1/1/2015 12:00:00 AM"


def staged(spark):
    folder = work_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("stage-")}


def test_usable_rows_go_when_their_source_is_settled(spark):
    """Refused rows stay readable, with their reason, and the account is whole."""
    before = staged(spark)
    df = spark.createDataFrame([("1", "1", "a"), ("1", "2", "b"), ("x", "1", "c"), ("2", "1", "")], "filing_id string, amend_id string, v string")
    ledger = Ledger("job")
    usable, bad = ledger.usable(df, "lines")
    good, refused = ledger.settle(latest.latest_amendment(usable, "filing_id", "amend_id"), "lines", {"no v": F.col("v") == ""})
    assert sorted(f[: f.rindex("-")] for f in staged(spark) - before) == ["stage-job-lines", "stage-job-lines-refused"]
    assert rows(good) == [("1", "2", "b")]
    assert rows(bad, "filing_id", "v", "reason") == [("x", "c", "bad filing id")] and rows(refused, "filing_id", "reason") == [("2", "no v")]
    assert rows(ledger.rejects(), "filing_id", "reason") == [("2", "no v"), ("x", "bad filing id")]
    assert rows(ledger.report(spark), "outcome", "n") == [("accepted", 1), ("bad filing id", 1), ("no v", 1), ("superseded", 1)]


def test_only_what_meets_is_counted_and_written(spark, monkeypatch):
    """An older registration's clients, payments of nobody's client and lines of no engagement don't go on."""
    def raw(name, *records):
        return spark.createDataFrame([tuple({"amend_id": "0", **r}.get(c) for c in RAW[name]) for r in records], raw_schema(name))

    firm = {"entity_cd": "FRM", "filer_naml": "Firm One"}
    sources = {
        "lobby_disclosure": raw("lobby_disclosure", {"filing_id": "200", "form_type": "F625", "filer_id": "F1", "from_date": JAN, **firm},
                                {"filing_id": "201", "form_type": "F625", "filer_id": "F2", "from_date": JAN, **firm, "filer_naml": "Firm Two"}),
        "registration": raw("registration", *[{"filing_id": n, "form_type": "F601", "ls_beg_yr": "2015", **firm} for n in ("500", "501")]),
        "employer_line": raw("employer_line", {"filing_id": "500", "cli_naml": "Old Client"}, *[{"filing_id": "501", "cli_naml": "Acme"}] * 2),
        "payment_line": raw("payment_line", *[{"filing_id": "200", "emplr_naml": n} for n in ("Acme", "Acme", "Stranger", "Old Client")]),
        "subcontract_line": raw("subcontract_line", *[{"filing_id": f, "firm_name": "Firm Two", "subj_naml": n}
                                                      for f, n in (("200", "Acme"), ("200", "Stranger"), ("201", "Acme"))]),
    }
    counted, written = {}, {}
    count, write = contracts._counted, contracts.stage

    def counting(df, name):
        counted[name] = df.count()
        return count(df, name)

    def writing(df, name):
        written[name] = (out := write(df, name)).count()
        return out

    monkeypatch.setattr(contracts, "_counted", counting)
    monkeypatch.setattr(contracts, "stage", writing)
    found, _ = contracts.subcontract_rows(sources, copies=True)
    assert rows(found, "emplr_name", "subfirm_name", "reg_filing_id") == [("ACME", "FIRM TWO", "501")] * 4
    assert counted["n_client"] == 2 and counted["n_line"] == 1 and written["paid"] == 1


@pytest.mark.parametrize("hashed", [True, False])
def test_latest_of_a_large_table_needs_no_sort(spark, monkeypatch, hashed):
    data = [("1", "9", "x"), ("1", "10", "x"), ("1", "10", "y"), ("1", "10", "y"), ("2", None, "z"), (None, "1", "n"), (None, "2", "n")]
    df = stage(spark.createDataFrame(data, "filing string, amend string, line string"), "large")
    monkeypatch.setattr(latest, "LARGE", 0)
    if not hashed:
        monkeypatch.setattr(latest, "HASHED", 0)  # more than the tasks can hold
    found = latest.latest_amendment(df, "filing", "amend")
    assert rows(found) == sorted([("1", "10", "x"), ("1", "10", "y"), ("1", "10", "y"), ("2", None, "z"), (None, "2", "n")], key=repr)
    assert ("ShuffledHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == hashed


def test_amendment_numbers_of_odd_text(spark):
    given = ["7", "007", " 7", "7 ", "+7", "-7", "7.9", "7x", "7\t", "\x017", "x7", "", None, "9" * 19, "9" * 25, "٣", "1e3"]
    df = spark.createDataFrame([(g,) for g in given], "t string")
    pattern = F.regexp_extract("t", r"^\s*([0-9]+)", 1).try_cast("bigint")
    assert df.filter(~amendment_no(F.col("t")).eqNullSafe(pattern)).count() == 0
    assert df.filter(amendment_no(F.col("t")) == 7).count() == 7


def fake_job(sources, mart=None):
    people = stage(mart_people(sources), "fake")
    if mart and "person" in mart:
        people = people.join(mart["person"], "_id", "left_anti")
    return {"person": people, "report": people}


def mart_people(spark):
    return spark.createDataFrame([(1, None, "A", None, "B", None, None), (1, None, "A", None, "B", None, None)], MART["person"].schema())


def test_checked_and_repeated_jobs_leave_no_tables(spark, monkeypatch):
    class Fake:
        def __init__(self, spark, folder):
            self.spark = spark

        def sources(self):
            return self.spark

    monkeypatch.setattr(catalog, "Filings", Fake)
    for module in (registrations, contracts, individuals, candidates, committees):
        name = module.__name__.rpartition(".")[2]
        monkeypatch.setattr(module, f"run_{name}", fake_job)
    monkeypatch.setattr(contracts, "run_subcontracts", fake_job)
    before = staged(spark)
    jobs = ("candidates", "committees", "contracts", "individuals", "registrations", "subcontracts")
    assert rows(catalog.mart_violations(spark, "")) == [(f"{j}.person", 2, 2) for j in jobs]
    assert rows(catalog._added_again(fake_job, spark, "")) == [("person", 2, 0)]
    assert staged(spark) == before


def test_a_source_without_refused_rows_is_settled(spark):
    """Its usable rows are gone, and the empty frames of refused rows read nothing of them."""
    before = staged(spark)
    ledger = Ledger("job")
    usable, bad = ledger.usable(spark.createDataFrame([("1", "1"), ("1", "2")], "filing_id string, amend_id string"), "lines")
    good, refused = ledger.settle(latest.latest_amendment(usable, "filing_id", "amend_id"), "lines")
    assert [f[: f.rindex("-")] for f in staged(spark) - before] == ["stage-job-lines"]
    assert rows(good) == [("1", "2")] and rows(bad) == rows(refused) == rows(ledger.rejects()) == []
    assert rows(bad.unionByName(refused).distinct().select("filing_id", "reason")) == []
