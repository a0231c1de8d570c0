"""The registered queries: each operator and job over the staging views of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.functions import codes
from filingloom.functions.text import (
    blank_to_null, clean, concat_names, or_default, parse_filing_ts, session_year, split_city_state, split_name,
)
from filingloom.operators import bills, checks, mart, offices, resolve, roles
from filingloom.operators.identity import merge_identities
from filingloom.operators.latest import latest_amendment
from filingloom.plans import candidates, committees, contracts, individuals, registrations
from filingloom.sources import commits, snapshots
from filingloom.sources.tables import MART, Table
from filingloom.staging import CORRUPT, Filings, family_name, filing_text, text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- latest amendments


@query
def latest_amendment_ties(spark, folder):
    f = Filings(spark, folder)
    return latest_amendment(f.table("lineitem"), "l_orderkey", "l_linenumber")


@query
def latest_amendment_single(spark, folder):
    lines = Filings(spark, folder).table("lineitem")
    return latest_amendment(lines, "l_orderkey", "l_linenumber", ties="single", tie_break=["l_partkey", "l_suppkey"])


@query
def latest_then_filter(spark, folder):
    f = Filings(spark, folder)
    covers = f.covers.select("filing_id", "amend_id", "form_type", "filer_id", "lby_actvty")
    wanted = F.col("form_type") == "F615"
    return latest_amendment(covers, "filing_id", "amend_id", where=wanted, rank_scope="filing")


@query
def filter_then_latest(spark, folder):
    f = Filings(spark, folder)
    covers = f.covers.select("filing_id", "amend_id", "form_type", "filer_id", "lby_actvty")
    wanted = F.col("form_type") == "F615"
    return latest_amendment(covers, "filing_id", "amend_id", where=wanted, rank_scope="form")


@query
def latest_registration_per_session(spark, folder):
    f = Filings(spark, folder)
    orders = f.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    per_session = orders.withColumn("ls", session_year(F.col("o_orderdate")))
    return latest_amendment(per_session, ["o_custkey", "ls"], "o_orderkey").select("o_custkey", "ls", "o_orderkey")


# ---- text


@query
def session_years(spark, folder):
    orders = Filings(spark, folder).table("orders").select("o_orderkey", "o_orderdate")
    raw = F.when(F.col("o_orderkey") % 17 == 0, F.lit(CORRUPT)).otherwise(filing_text(F.col("o_orderdate")))
    return orders.withColumn("raw", raw).select("o_orderkey", session_year(parse_filing_ts(F.col("raw"))).alias("ls"))


def _raw_dates() -> Column:
    """Good dates, and the ways in which they are bad, by key."""
    good, key = filing_text(F.col("o_orderdate")), F.col("o_orderkey") % 17
    return (
        F.when(key == 0, F.lit(CORRUPT)).when(key == 1, F.lit("")).when(key == 2, F.lit("13/40/2016 1:00:00 AM"))
        .when(key == 3, F.concat(F.lit("0"), F.date_format("o_orderdate", "M/d/yyyy"))).when(key == 4, F.lower(good))
        .when(key == 5, F.replace(good, F.lit("12:00"), F.lit("1:30"))).when(key != 6, good)
    )


@query
def parse_dates(spark, folder):
    """Strict use quarantines what does not parse (missing), lenient use keeps the null."""
    orders = Filings(spark, folder).table("orders").select("o_orderkey", "o_orderdate").withColumn("raw", _raw_dates())
    parsed = parse_filing_ts(F.col("raw"))
    return orders.select(
        "o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"), parsed.isNull().alias("missing")
    )


@query
def clean_text(spark, folder):
    docs = Filings(spark, folder).table("documents").select("doc_id", "source", "lang", "text")
    padded = F.concat(F.lit("\t "), F.col("source"), F.lit(" \n"))
    blanked = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("lang"))
    return docs.select(
        "doc_id", clean(padded).alias("upper_stripped"), clean(padded, upper=False).alias("stripped"),
        F.upper("source").alias("upper_only"), blank_to_null(blanked).alias("or_null"),
        or_default(blanked).alias("or_default"), F.length(clean(F.col("text"), upper=False)).alias("n_stripped"),
    )


def _raw_names(f: Filings) -> DataFrame:
    key = F.col("p_partkey")
    return f.table("part").select("p_partkey", "p_name", "p_brand").select(
        "p_partkey",
        F.when(key % 5 == 0, F.lit("")).when(key % 5 == 1, F.concat("p_name", F.lit("."))).when(key % 5 == 2, F.lit("solo"))
        .otherwise(F.concat(F.lit(" "), F.col("p_name"))).alias("first"),
        F.when(key % 7 == 0, F.lit("Q.")).when(key % 7 == 1, F.lit(" ")).otherwise(F.lit("")).alias("middle"),
        F.when(key % 6 == 0, F.concat("p_name", F.lit(" Jr."))).when(key % 6 == 1, F.concat("p_brand", F.lit(" Sr. ")))
        .when(key % 6 == 2, F.concat("p_name", F.lit("\t B."))).otherwise(F.col("p_name")).alias("last"),
        F.when(key % 4 == 0, F.lit("III")).otherwise(F.lit("")).alias("suffix"),
    )


def _split(spark, folder, mode):
    raw = _raw_names(Filings(spark, folder))
    parts = split_name(F.col("first"), F.col("middle"), F.col("last"), F.col("suffix"), mode)
    return raw.select("p_partkey", *[c.alias(n) for n, c in parts.items()])


@query
def split_names(spark, folder):
    return _split(spark, folder, "always")


@query
def split_names_dotted(spark, folder):
    return _split(spark, folder, "dotted")


@query
def split_place(spark, folder):
    f = Filings(spark, folder)
    n = f.table("nation").join(f.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = f.table("supplier").select("s_suppkey", "s_nationkey").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey") % 4
    city = (
        F.when(key == 0, F.concat("n_name", F.lit(", "), "r_name")).when(key == 1, F.concat("n_name", F.lit(", x, "), "r_name"))
        .when(key == 2, F.col("n_name"))
    )
    parts = split_city_state(F.col("raw_city"), F.col("r_name"))
    return s.withColumn("raw_city", city).select("s_suppkey", *[c.alias(name) for name, c in parts.items()])


@query
def concat_nullable(spark, folder):
    p = Filings(spark, folder).table("part").select("p_partkey", "p_brand", "p_type")
    return p.select(
        "p_partkey",
        concat_names(
            F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")), F.when(F.col("p_partkey") % 7 != 0, F.col("p_type"))
        ).alias("org_name"),
    )


# ---- the filing queries


@query
def latest_ethics(spark, folder):
    return registrations.latest_ethics((f := Filings(spark, folder)).registrations)


@query
def registration_employment(spark, folder):
    rows, _ = registrations.registration_rows((f := Filings(spark, folder)).sources())
    return rows.select(
        "lb_filer_id", "last", "first", "org_name", "ls", "ethics", "filing_id", "amend_id", "form_type", "org_filer_id",
        "type", "city", "state", "lby_actvty", F.col("start").alias("period_start"), F.col("end").alias("period_end"),
    )


CONTRACT_COLUMNS = [
    "act_filing_id", "act_amend_id", "firm_filer_id", "firm_name", "firm_city", "firm_st", "filing_start", "ls",
    "reg_filing_id", "reg_amend_id", "emplr_name", "eff_date", "con_period", "lby_actvty",
]


@query
def contracts_not_subcontracted(spark, folder):
    rows, _ = contracts.contract_rows(Filings(spark, folder).sources(), copies=True)
    return rows.select(*CONTRACT_COLUMNS, "cli_city", "cli_st")


@query
def contracts_with_bad_ids(spark, folder):
    """The same over sources some of whose ids are no numbers: those rows make no contract and hide none."""
    rows, _ = contracts.contract_rows(Filings(spark, folder, damaged=True).sources(), copies=True)
    return rows.select(*CONTRACT_COLUMNS, "cli_city", "cli_st")


@query
def subcontracts(spark, folder):
    rows, _ = contracts.subcontract_rows(Filings(spark, folder).sources(), copies=True)
    return rows.select(*CONTRACT_COLUMNS, "subfirm_name", "subfirm_city", "subfirm_st")


@query
def individual_filings(spark, folder):
    return individuals.individual_rows((f := Filings(spark, folder)).sources())


# ---- entity resolution


@query
def prefix_match(spark, folder):
    """People whose middle name starts with the given one: tier one of the person cascade."""
    f = Filings(spark, folder)
    return resolve.resolve_people(_person_probes(f), resolve.person_names(f.master_person)).filter(
        "match_rule IN ('middle', 'ambiguous_middle')"
    ).select("o_orderkey", "match_rule", "master_pid")


def _person_probes(f: Filings) -> DataFrame:
    o = f.table("orders").select("o_orderkey", "o_custkey")
    c = f.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    key = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        F.when(key % 31 == 0, F.lit("NOBODY")).otherwise(F.col("c_mktsegment")).alias("first"),
        F.when(key % 6 == 0, F.lit("Q.")).when(key % 6 == 1, F.lit("MA")).when(key % 6 == 2, F.lit("ZED"))
        .when(key % 6 == 3, F.lit(".")).alias("middle"),
        family_name().alias("last"),
    )


@query
def registration_rejects(spark, folder):
    """Covers that the registrations can't use, with the reason."""
    return registrations.registration_rows(Filings(spark, folder).sources())[1]


@query
def contract_rejects(spark, folder):
    return contracts.unfit_covers(Filings(spark, folder).covers)


@query
def committee_rejects(spark, folder):
    return committees.run_committees(Filings(spark, folder).sources())["rejected_covers"]


def _account(run, spark, folder):
    return run(Filings(spark, folder, damaged=True).sources(), {})["ledger"]


# What becomes of the rows of each source, with ids, names, dates and years that can't be used: outcomes add up to the rows.


@query
def registration_ledger(spark, folder):
    return _account(registrations.run_registrations, spark, folder)


@query
def contract_ledger(spark, folder):
    return _account(contracts.run_contracts, spark, folder)


@query
def subcontract_ledger(spark, folder):
    return _account(contracts.run_subcontracts, spark, folder)


@query
def individual_ledger(spark, folder):
    return _account(individuals.run_individuals, spark, folder)


@query
def candidate_ledger(spark, folder):
    return _account(candidates.run_candidates, spark, folder)


@query
def committee_ledger(spark, folder):
    return _account(committees.run_committees, spark, folder)


@query
def person_cascade(spark, folder):
    f = Filings(spark, folder)
    return resolve.resolve_people(_person_probes(f), resolve.person_names(f.master_person)).select(
        "o_orderkey", "first", "middle", "last", "master_pid", "match_rule", F.col("n_candidates").cast("bigint").alias("n_candidates")
    )


def _org_probe_rows(f: Filings) -> DataFrame:
    """Suppliers, parts under their own or a wrong place, names nobody has, and placeholders."""
    li = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = f.table("part").select("p_partkey", "p_name", "p_brand", "p_size")
    s = f.table("supplier").select("s_suppkey", "s_name")
    rows = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    kind = F.col("l_orderkey") % 5
    return rows.select(
        F.when(kind == 0, F.concat(F.lit(" "), "s_name")).when(kind == 3, F.concat(F.lit("Unheard of "), text("l_partkey")))
        .when(kind == 4, F.when(F.col("l_partkey") % 2 == 0, "x").otherwise("None ")).otherwise(F.col("p_name")).alias("org_name"),
        F.when(F.col("l_partkey") % 4 != 0, text("l_suppkey")).alias("filer_id"),
        F.when(F.col("l_orderkey") % 2 == 0, "FRM").otherwise("LEM").alias("type"),
        F.when(kind == 2, F.lit("elsewhere")).otherwise(F.col("p_brand")).alias("city"),
        F.concat(F.lit("S"), text("p_size")).alias("state"),
        F.col("l_orderkey").alias("filing_no"), F.col("l_linenumber").alias("amend_no"),
    )


def _org_label(resolved: DataFrame, new_orgs: DataFrame) -> DataFrame:
    """Resolved rows with the organisation in readable form: its master id, or what a new one is made of."""
    made = F.concat_ws("|", F.lit("new"), "name", F.coalesce("city", F.lit("")), F.coalesce("state", F.lit("")))
    named = new_orgs.select("organization_id", made.alias("_made"))
    return resolved.join(named, "organization_id", "left").withColumn(
        "org", F.coalesce("_made", F.concat(F.lit("oid:"), text("organization_id")))
    ).drop("_made")


ORG_ORDER = ["filing_no", "amend_no"]


@query
def org_cascade(spark, folder):
    f = Filings(spark, folder)
    probes = snapshots.stage(resolve.org_probes(_org_probe_rows(f), ORG_ORDER), "org-probes")
    resolved, new_orgs = resolve.resolve_orgs(probes, f.master_org, ORG_ORDER)
    return _org_label(resolved, new_orgs).select(
        "org_name", "filer_id", "type", "org", "match_rule", F.col("n_candidates").cast("bigint").alias("n_candidates")
    )


def _by_filer(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Committees: a filer that has an organisation keeps it; others take that of their first row."""
    f = Filings(spark, folder)
    bridge = f.table("supplier").filter("s_suppkey % 2 = 0").select(
        (F.col("s_suppkey") + 5_000_000).alias("organization_id"), text("s_suppkey").alias("filer_id")
    )
    probes = snapshots.stage(resolve.org_probes(_org_probe_rows(f), ORG_ORDER), "filer-probes")
    return resolve.resolve_orgs(probes, f.master_org, ORG_ORDER, bridge=bridge, by_filer=True)


@query
def org_by_filer_first(spark, folder):
    """The names of filers that have an organisation already."""
    resolved, _ = _by_filer(spark, folder)
    return resolved.filter("match_rule = 'filer'").select(
        "org_name", "filer_id", "type", F.concat(F.lit("oid:"), text("organization_id")).alias("org"), "match_rule"
    )


@query
def org_by_filer_cascade(spark, folder):
    """The names of the other filers, each resolved as its filer's first row, and names without a filer."""
    resolved, new_orgs = _by_filer(spark, folder)
    rest = resolved.filter("match_rule <> 'filer'")
    return _org_label(rest, new_orgs).select("org_name", "filer_id", "type", "org", "match_rule")


@query
def unmatched_report(spark, folder):
    f = Filings(spark, folder)
    probes = snapshots.stage(resolve.org_probes(_org_probe_rows(f), ORG_ORDER), "report-probes")
    return resolve.match_summary(resolve.resolve_orgs(probes, f.master_org, ORG_ORDER)[0])


def _name_events(f: Filings) -> DataFrame:
    """Events as filings of a user under a first and last name that vary with the event."""
    names = F.when(F.col("event_id") % 11 == 0, F.concat("event_type", F.lit("x"))).otherwise(F.col("event_type"))
    other = F.element_at(
        F.array(*[F.lit(v) for v in ("click", "view", "family", "error", "clickx")]), (F.col("event_id") % 5 + 1).cast("int")
    )
    return f.table("events").select(
        "event_id", F.when(F.col("user_id") % 20 == 0, F.lit("")).otherwise(text("user_id")).alias("filer_id"),
        names.alias("first"), other.alias("last"), "value",
    )


@query
def within_run_identity(spark, folder):
    f = Filings(spark, folder)
    merged = merge_identities(_name_events(f), "filer_id", "first", "last", ["event_id"])
    return merged.select("event_id", "filer_id", "first", "last", "anchor_first", "anchor_last")


def _people_events(f: Filings) -> tuple[DataFrame, DataFrame]:
    events = f.table("events").select("event_id", "user_id", "event_type", "value")
    incoming = events.select(
        "event_id", "user_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("first"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("M"), text(F.col("event_id") % 7))).alias("middle"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("L"), text(F.col("event_id") % 4))).alias("last"),
    )
    return mart.first_wins(incoming, ["user_id"], ["event_id"]), incoming


@query
def fill_missing(spark, folder):
    stored, incoming = _people_events(Filings(spark, folder))
    return resolve.fill_missing(stored, incoming, ["user_id"], ["first", "middle", "last"], ["event_id"])


@query
def name_conflicts(spark, folder):
    f = Filings(spark, folder)
    stored, incoming = _people_events(f)
    return resolve.conflicts(stored, incoming, ["user_id"], ["first", "middle", "last"])


# ---- mart building


@query
def first_wins_insert(spark, folder):
    f = Filings(spark, folder)
    lines = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    loaded = f.table("orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    return mart.first_wins(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"], loaded).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


def _agreements(f: Filings) -> DataFrame:
    li = f.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    raw = F.when(F.col("l_partkey") % 17 == 0, F.lit(CORRUPT)).otherwise(filing_text(F.date_trunc("month", "l_shipdate")))
    return li.select(
        F.col("l_suppkey").alias("firm"), (F.col("l_partkey") % 40).alias("employer"),
        parse_filing_ts(raw).cast("date").alias("effective_date"), F.col("l_orderkey").alias("filing_no"),
    )


@query
def insert_or_reject(spark, folder):
    f = Filings(spark, folder)
    accepted, rejected = mart.insert_or_reject(
        _agreements(f), {"no effective date": F.col("effective_date").isNull()},
        ["firm", "employer", "effective_date"], ["filing_no"],
    )
    kept = accepted.withColumns({"reason": F.lit("accepted"), "copies": F.lit(1).cast("bigint")})
    return kept.unionByName(rejected)


@query
def lookup_or_insert_keys(spark, folder):
    """Distinct natural keys, their stored id or none, and whether new ids tell all keys apart."""
    orders = Filings(spark, folder).table("orders").select("o_orderpriority", "o_orderstatus", "o_custkey")
    key = ["o_custkey", "o_orderpriority"]
    known = orders.filter("o_orderstatus = 'F'").groupBy(*key).agg(F.max("o_custkey").alias("_id"))
    found = mart.lookup_or_create(orders, key, known, kind="example")
    clashes = mart.key_collisions(found.filter("is_new"), "_id", key).select(F.col("_id").alias("_clash")).distinct()
    return found.join(clashes, F.col("_id") == F.col("_clash"), "left").select(
        *key, "is_new", F.when(~F.col("is_new"), F.col("_id")).alias("stored_id"),
        (F.col("is_new") & (F.col("_id") < 0) & F.col("_clash").isNull()).alias("made_unique"),
    )


@query
def filer_bridge(spark, folder):
    f = Filings(spark, folder)
    people = f.table("customer").select(
        F.col("c_custkey").alias("person_id"), F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("C"), text("c_custkey"))).alias("filer_id")
    )
    orgs = f.table("lineitem").select(
        F.col("l_suppkey").alias("organization_id"), F.when(F.col("l_suppkey") % 7 == 0, F.lit("")).otherwise(text("l_suppkey")).alias("filer_id")
    )
    return mart.filer_bridge(people, orgs)


@query
def subtype_routing(spark, folder):
    orders = Filings(spark, folder).table("orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    priority = F.col("o_orderpriority")
    routed = mart.route(orders, {
        "controlled": (priority == "1-URGENT") | (F.col("o_orderstatus") == "P"),
        "ballot": priority == "2-HIGH",
        "general": priority.isin("3-MEDIUM", "5-LOW"),
        "independent": priority == "4-NOT SPECIFIED",
    }, ["o_custkey"])
    parts = [df.select(F.lit(kind).alias("subtype"), "o_custkey") for kind, df in routed.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def role_unpivot_resolve(spark, folder):
    """Firm and employer of each line, resolved as roles and put back as columns."""
    f = Filings(spark, folder)
    li = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = f.table("part").select("p_partkey", "p_name", "p_brand", "p_size")
    s = f.table("supplier").select("s_suppkey", "s_name")
    rows = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).select(
        "l_orderkey", "l_linenumber", F.upper("s_name").alias("firm"), text("l_suppkey").alias("firm_filer"),
        F.upper("p_name").alias("employer"), "p_brand", F.concat(F.lit("S"), text("p_size")).alias("p_state"),
    )
    rows = snapshots.stage(rows, "role-lines")
    named = roles.unpivot_roles(rows, {
        "FRM": {"org_name": F.col("firm"), "filer_id": F.col("firm_filer")},
        "LEM": {"org_name": F.col("employer"), "city": F.col("p_brand"), "state": F.col("p_state")},
    }, ["l_orderkey", "l_linenumber"])
    order = ["l_orderkey", "l_linenumber"]
    probes = snapshots.stage(resolve.org_probes(named, order), "role-probes")
    resolved = snapshots.stage(resolve.resolve_orgs(probes, f.master_org, order)[0], "role-resolved")
    known = resolved.withColumn("organization_id", F.when(F.col("organization_id") >= 0, F.col("organization_id")))
    both = roles.attach_roles(rows, known, {
        "firm_id": ("FRM", F.col("firm"), F.col("firm_filer")), "employer_id": ("LEM", F.col("employer"), None),
    })
    return both.select("l_orderkey", "l_linenumber", "firm", "employer", "firm_id", "employer_id")


@query
def link_table(spark, folder):
    """Orders linked to the shipping months of their lines, one row per pair."""
    f = Filings(spark, folder)
    orders = f.table("orders").select(F.col("o_orderkey").alias("filing_id"), F.col("o_custkey").alias("employed_id"))
    acts = f.table("lineitem").select(
        F.col("l_orderkey").alias("filing_id"), (F.col("l_suppkey") * 10 + F.month("l_shipdate")).alias("activity_id")
    )
    return mart.link(orders, acts, ["filing_id"], ["employed_id", "activity_id"])


@query
def add_parties(spark, folder):
    """Parties a person files under beyond the stored ones, with all parties of each person."""
    f = Filings(spark, folder)
    filed = f.table("orders").select(F.col("o_custkey").alias("person_id"), F.col("o_orderpriority").alias("party"))
    stored = f.table("customer").select(F.col("c_custkey").alias("person_id"), F.lit("1-URGENT").alias("party"))
    parties = mart.parties_of(filed).select("person_id", F.concat_ws(",", "parties").alias("parties"))
    return mart.add_parties(filed, stored).join(parties, "person_id")


@query
def code_lookup(spark, folder):
    rows = Filings(spark, folder).intentions.select("filing_id", "amend_id", "office_cd", "offic_dscr", "juris_cd", "elec_type", "district_cd")
    for column, table, text_col in (
        ("office_cd", codes.OFFICE, "offic_dscr"), ("juris_cd", codes.JURISDICTION, None),
        ("elec_type", codes.ELECTION, None), ("district_cd", codes.DISTRICT, None),
    ):
        rows = mart.decode(rows, column, table, f"{column}_label", text_col)
    return rows.select("filing_id", "amend_id", "office_cd_label", "juris_cd_label", "elec_type_label", "district_cd_label")


@query
def party_lookup(spark, folder):
    rows = Filings(spark, folder).intentions.select("filing_id", "amend_id", "party_cd", "party")
    return offices.decode_party(rows).select("filing_id", "amend_id", "party", "party_given")


@query
def json_side_output(spark, folder):
    """People written as JSON and read back with a declared schema."""
    people = resolve.person_names(Filings(spark, folder).master_person).select(
        F.col("pid").alias("_id"), F.lit(None).cast("bigint").alias("master_pid"), "first", "middle", "last"
    )
    path = snapshots.new_path(spark, "people-json")
    snapshots.write_json(people, path)
    return snapshots.read_json(spark, path, people.schema)


@query
def bill_mentions(spark, folder):
    covers = Filings(spark, folder).covers.select("filing_id", "amend_id", "lby_actvty")
    return bills.bill_mentions(covers, "lby_actvty", ["filing_id", "amend_id"])


@query
def bill_coverage(spark, folder):
    """Mentions that name a known bill: parts stand in for bills, one session each."""
    f = Filings(spark, folder)
    known = f.table("part").select(
        F.concat(F.lit("CA_"), text("p_partkey")).alias("bid"), F.when(F.col("p_partkey") % 2 == 0, "AB").otherwise("SB").alias("type"),
        text("p_partkey").alias("number"), F.lit(1997).alias("session_year"), F.lit("CA").alias("state"),
    )
    covers = f.covers.select("filing_id", session_year(parse_filing_ts(F.col("from_date"))).alias("ls"), "lby_actvty")
    return bills.bill_coverage(bills.link_bills(
        bills.bill_mentions(covers, "lby_actvty", ["filing_id", "ls"]), known, "ls"
    ))


LINE_CONTRACT = Table(
    {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_returnflag": "varchar(1)", "brand": "varchar(7)"},
    ("l_orderkey", "l_linenumber"), (("l_orderkey", "l_partkey"),), ("brand",),
    {("l_partkey",): ("small_part", ("p_partkey",)), ("l_orderkey", "l_returnflag"): ("flagged", ("k", "f"))},
    {"l_returnflag": ("A", "N")},
)


@query
def contract_violations(spark, folder):
    """Every kind of check over the lines, with each violation counted."""
    f = Filings(spark, folder)
    li = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    p = f.table("part").select("p_partkey", "p_brand", "p_size")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(
        *li.columns, F.when(F.col("p_size") % 10 != 0, F.col("p_brand")).alias("brand")
    )
    parents = {
        "small_part": p.filter("p_size <= 40").select("p_partkey"),
        "flagged": f.table("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.lit("A").alias("f")),
    }
    return checks.check(rows, "line", LINE_CONTRACT, parents)


# ---- jobs, with ids turned back into what they stand for


def _orgs(out: dict[str, DataFrame]) -> DataFrame:
    return _org_label(out["org_matches"].select("organization_id").distinct(), out["organizations"])


def _with_org(df: DataFrame, orgs: DataFrame, column: str, name: str) -> DataFrame:
    labels = orgs.select(F.col("organization_id").alias(column), F.col("org").alias(name))
    return df.join(labels, column, "left")


def _with_person(df: DataFrame, out: dict[str, DataFrame], column: str) -> DataFrame:
    """The person as filer id and stored name."""
    filers = out["filer_id"].filter("person_id IS NOT NULL").select(F.col("person_id").alias("_id"), F.col("filer_id").alias("person_filer"))
    people = out["person"].join(filers, "_id", "left").select(
        F.col("_id").alias(column), "person_filer", F.col("first").alias("p_first"), F.col("middle").alias("p_middle"),
        F.col("last").alias("p_last"), F.col("suffix").alias("p_suffix"), F.col("master_pid").alias("p_master"),
    )
    return df.join(people, column, "left")


PERSON_COLUMNS = ["person_filer", "p_first", "p_middle", "p_last", "p_suffix", "p_master"]


@query
def employment_mart(spark, folder):
    """Permanent and direct employment as the registrations job loads them."""
    out = registrations.run_registrations((f := Filings(spark, folder)).sources())
    common = ["lobbyist_id", F.col("start").alias("period_start"), F.col("end").alias("period_end"), "legislative_session", "ethics_completion"]
    permanent = out["permanent_employment"].select(F.lit("firm").alias("kind"), F.col("lobbying_firm_id").alias("oid"), *common)
    direct = out["direct_employment"].select(F.lit("employer").alias("kind"), F.col("lobbyist_employer_id").alias("oid"), *common)
    rows = _with_person(_with_org(permanent.unionByName(direct), _orgs(out), "oid", "org"), out, "lobbyist_id")
    return rows.select("kind", "org", *PERSON_COLUMNS, "period_start", "period_end", "legislative_session", "ethics_completion")


@query
def employed_lobbying_mart(spark, folder):
    """Activities linked to direct employment, from the registrations job."""
    out = registrations.run_registrations((f := Filings(spark, folder)).sources())
    employed = out["direct_employment"].select(F.col("_id").alias("employed_id"), "lobbyist_id", F.col("lobbyist_employer_id").alias("oid"), F.col("start").alias("period_start"))
    acts = out["activity"].select(F.col("_id").alias("activity_id"), "activity", "filing_id", "amendment_id")
    rows = out["employed_lobbying"].join(employed, "employed_id").join(acts, "activity_id")
    rows = _with_person(_with_org(rows, _orgs(out), "oid", "org"), out, "lobbyist_id")
    return rows.select("person_filer", "p_first", "org", "period_start", "activity", "filing_id", "amendment_id")


@query
def contract_mart(spark, folder):
    """Accepted contracts with their activity, and refused ones with the reason."""
    out = contracts.run_contracts((f := Filings(spark, folder)).sources())
    return _agreement_rows(out, "contract", "contracted_lobbying", "contract_id", ["lobbying_firm_id", "lobbyist_employer_id"])


@query
def subcontract_mart(spark, folder):
    out = contracts.run_subcontracts((f := Filings(spark, folder)).sources())
    return _agreement_rows(
        out, "subcontract", "subcontracted_lobbying", "subcontract_id",
        ["subcontracting_firm_id", "subcontracted_firm_id", "employer_id"],
    )


def _agreement_rows(out, table, link, link_id, org_columns):
    acts = out["activity"].select(F.col("_id").alias("activity_id"), "activity", F.col("filing_id").alias("act_filing"))
    accepted = out[table].withColumnRenamed("_id", link_id).join(out[link], link_id).join(acts, "activity_id")
    columns = [*org_columns, "601_filing_id", "601_amendment_id", "filing_date", "effective_date", "period_of_contract", "legislative_session"]
    accepted = accepted.select(*columns, "activity", "act_filing", F.lit("accepted").alias("reason"), F.lit(1).cast("bigint").alias("copies"))
    refused = out["rejected"].select(
        *columns, F.col("lby_actvty").alias("activity"), F.col("act_filing_no").alias("act_filing"), "reason", "copies"
    )
    rows, orgs = accepted.unionByName(refused), _orgs(out)
    for c in org_columns:
        rows = _with_org(rows, orgs, c, c.replace("_id", "_org"))
    return rows.drop(*org_columns).withColumnsRenamed({"601_filing_id": "filing_601", "601_amendment_id": "amendment_601"})


@query
def individual_mart(spark, folder):
    out = individuals.run_individuals((f := Filings(spark, folder)).sources())
    acts = out["activity"].withColumnRenamed("_id", "activity_id")
    rows = _with_org(out["individual_lobbying"].join(acts, "activity_id"), _orgs(out), "organization_id", "org")
    return rows.select("org", "filing_date", "legislative_session", "activity", "filing_id", "amendment_id")


@query
def candidate_mart(spark, folder):
    """Who runs for what, with the office and its district, as the candidates job loads them."""
    out = candidates.run_candidates((f := Filings(spark, folder)).sources())
    office = out["office"].join(out["district"].withColumnRenamed("_id", "district_id"), "district_id", "left").select(
        F.col("_id").alias("election_office_id"), "title", "agency", "jurisdiction", F.col("number").alias("district_number")
    )
    rows = _with_person(out["running"].join(office, "election_office_id"), out, "candidate_id")
    return rows.select(
        *PERSON_COLUMNS, "title", "agency", "jurisdiction", "district_number", "election_type", "election_year",
        F.col("501_filing_id").alias("filing_501"), F.col("501_amendment_id").alias("amendment_501"),
    )


@query
def candidate_parties(spark, folder):
    out = candidates.run_candidates((f := Filings(spark, folder)).sources())
    return _with_person(out["candidate"], out, "person_id").select("person_filer", "p_first", "party")


@query
def candidate_offices(spark, folder):
    """Offices with the first district seen and how many districts were named for each."""
    rows = candidates.intention_rows((f := Filings(spark, folder)).intentions)
    derived = offices.derive_offices(rows.drop("title"), ["filing_no", "amend_no"])
    office, district = derived["office"], derived["district"].withColumnRenamed("_id", "district_id")
    elections = derived["election"].groupBy(F.col("office_id").alias("_id")).agg(F.count(F.lit(1)).alias("n_elections"))
    return (
        office.join(district, "district_id", "left").join(elections, "_id", "left")
        .join(derived["district_conflicts"], ["title", "agency", "jurisdiction"], "left")
        .select("title", "agency", "jurisdiction", "chamber", "number", "n_elections", "n_districts")
    )


@query
def committee_subtypes(spark, folder):
    """Committees with their statement and every subtype."""
    out = committees.run_committees((f := Filings(spark, folder)).sources())
    kinds = [out[t].select(F.lit(t).alias("subtype"), F.col("committee_id").alias("organization_id"))
             for t in ("general_committee", "independent_committee", "ballot_committee")]
    subtypes = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    rows = _with_org(out["committee"].join(subtypes, "organization_id", "left"), _orgs(out), "organization_id", "org")
    return rows.select("org", "subtype", F.col("410_filing_id").alias("filing_410"), F.col("410_amendment_id").alias("amendment_410"))


@query
def ballot_support(spark, folder):
    out = committees.run_committees((f := Filings(spark, folder)).sources())
    rows = out["ballot_support"].join(out["ballot"], ["ballot_number", "legislative_session"])
    return _with_org(rows, _orgs(out), "committee_id", "org").select(
        "org", "ballot_number", "legislative_session", "position", "name", "jurisdiction"
    )


def _loaded_candidates(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    loaded = candidates.run_candidates(sources)
    return {t: snapshots.stage(loaded[t], t) for t in ("person", "filer_id", "candidate")}


@query
def controlled_committees(spark, folder):
    """Committees and the candidate who controls each, after the candidates job has loaded people."""
    sources = Filings(spark, folder).sources()
    mart_frames = _loaded_candidates(sources)
    out = committees.run_committees(sources, mart_frames)
    rows = _with_org(out["controlled_committee"], _orgs(out), "committee_id", "org")
    return _with_person(rows, mart_frames, "candidate_id").select("org", "person_filer", "p_first")


@query
def org_xref_rerun(spark, folder):
    """The reference table after a rerun that reads the first run's snapshot; the rerun adds nothing."""
    f = Filings(spark, folder)
    probes = snapshots.stage(resolve.org_probes(_org_probe_rows(f), ORG_ORDER), "xref-probes")
    resolved, new_orgs = resolve.resolve_orgs(probes, f.master_org, ORG_ORDER)
    key = ["org_name", "filer_id", "type"]
    path = snapshots.new_path(spark, "org-xref")
    snapshots.write_snapshot(resolved.select(*key, "organization_id"), path)
    xref = snapshots.read_xref(spark, path)
    again, made_again = resolve.resolve_orgs(probes, f.master_org, ORG_ORDER, xref=xref)
    added = mart.without(again.select(*key, "organization_id"), xref, [*key, "organization_id"])
    merged = snapshots.merge_snapshot(xref, added.unionByName(made_again.select(
        F.col("name").alias("org_name"), F.lit("").alias("filer_id"), F.lit("again").alias("type"), "organization_id"
    )), key)
    return _org_label(merged, new_orgs).join(again.select(*key, "match_rule"), key, "left").select(*key, "org", "match_rule")


@query
def committee_candidates_json(spark, folder):
    """Candidates who control or are named by a committee, written as JSON and read back with a declared schema."""
    sources = Filings(spark, folder).sources()
    mart_frames = _loaded_candidates(sources)
    people = committees.run_committees(sources, mart_frames)["committee_candidates"]
    path = snapshots.new_path(spark, "committee-candidates-json")
    snapshots.write_json(people, path)
    rows = _with_person(snapshots.read_json(spark, path, people.schema), mart_frames, "_id")
    return rows.select("person_filer", "p_first", "first", "middle", "last", "suffix", "title")


MART_TABLES = {*MART, "org_xref", "organizations"}
UPDATES = {"person_updates": ("person", ["_id"])}


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A small result written where it outlives the work scope whose tables it is computed from."""
    path = snapshots.new_path(df.sparkSession, name)
    snapshots.write_snapshot(df, path)
    return snapshots.read_snapshot(df.sparkSession, path, df.schema)


def _added_again(run: Callable[[dict, dict], dict], spark: SparkSession, folder: str) -> DataFrame:
    """A job commits its tables, then runs again on them: the rows of each table, and how many the second run adds."""
    sources, mart_folder = Filings(spark, folder).sources(), snapshots.new_path(spark, "mart")
    commits.run_job(spark, mart_folder, run, sources, MART_TABLES, UPDATES)
    kept = commits.read_mart(spark, mart_folder)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    with snapshots.work_scope(spark):
        second = run(sources, kept)
        rows = [df.select(F.lit(t).alias("table"), one.alias("rows"), none.alias("added")) for t, df in kept.items()]
        rows += [second[t].select(F.lit(t).alias("table"), none.alias("rows"), one.alias("added")) for t in second if t in MART_TABLES]
        return _kept(reduce(DataFrame.unionByName, rows).groupBy("table").agg(F.sum("rows").alias("rows"), F.sum("added").alias("added")), "added")


@query
def registration_rerun(spark, folder):
    return _added_again(registrations.run_registrations, spark, folder)


@query
def contract_rerun(spark, folder):
    return _added_again(contracts.run_contracts, spark, folder)


@query
def subcontract_rerun(spark, folder):
    return _added_again(contracts.run_subcontracts, spark, folder)


@query
def individual_rerun(spark, folder):
    return _added_again(individuals.run_individuals, spark, folder)


@query
def candidate_rerun(spark, folder):
    """With offices told apart by district, as stored offices name their district by its id."""
    return _added_again(partial(candidates.run_candidates, district_in_key=True), spark, folder)


@query
def committee_rerun(spark, folder):
    return _added_again(committees.run_committees, spark, folder)


@query
def mart_violations(spark, folder):
    """Rows and violations of the declared contracts in each table that a job fills, by job and table."""
    jobs = {
        "registrations": registrations.run_registrations, "contracts": contracts.run_contracts,
        "subcontracts": contracts.run_subcontracts, "individuals": individuals.run_individuals,
        "candidates": candidates.run_candidates, "committees": committees.run_committees,
    }
    sources, rows = Filings(spark, folder).sources(), []
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    for job, run in jobs.items():
        with snapshots.work_scope(spark):  # a job's tables go when they are counted
            filled = {t: snapshots.stage(df, f"checked-{t}") for t, df in run(sources, {}).items() if t in MART}
            found = [df.select(F.lit(f"{job}.{t}").alias("table"), one.alias("rows"), none.alias("violations")) for t, df in filled.items()]
            found.append(checks.check_mart(filled, MART).select(F.concat(F.lit(f"{job}."), "table").alias("table"), none.alias("rows"), F.col("n").alias("violations")))
            summed = reduce(DataFrame.unionByName, found).groupBy("table").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))
            rows.append(_kept(summed, "violations"))
    return reduce(DataFrame.unionByName, rows)


@query
def planted_violations(spark, folder):
    """What the checks find in the candidates' tables after faults are put into every row of three of them."""
    filled = candidates.run_candidates(Filings(spark, folder).sources())
    good = {t: snapshots.stage(filled[t], f"planted-{t}") for t in ("candidate", "district", "election", "office")}
    unlisted = good["candidate"].withColumn("party", F.lit("NOBODY"))
    faulty = {
        "candidate": unlisted.unionByName(unlisted),  # a repeated key, and a party that is not in the list
        "district": good["district"].withColumn("number", F.lit(None).cast("string")),
        "office": good["office"].filter(F.lit(False)),  # elections lose their office
        "election": good["election"],
    }
    found = checks.check_mart(faulty, MART)
    return found.groupBy("table", "check", "detail").agg(F.sum("n").alias("violations"))
