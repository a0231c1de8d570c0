"""Declared tables: raw filings, master data, and the mart with its keys, widths and domains."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID, DATE, YEAR, FLAG = "bigint", "date", "int", "boolean"


def text(width: int) -> str:
    return f"varchar({width})"


@dataclass(frozen=True)
class Table:
    """A table's columns and constraints, as data that `operators.checks` tests."""

    columns: dict[str, str]
    primary: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    # columns -> (parent table, parent columns)
    parents: dict[tuple[str, ...], tuple[str, tuple[str, ...]]] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def widths(self) -> dict[str, int]:
        return {c: int(t[8:-1]) for c, t in self.columns.items() if t.startswith("varchar(")}

    def schema(self) -> T.StructType:
        kinds = {ID: T.LongType(), DATE: T.DateType(), YEAR: T.IntegerType(), FLAG: T.BooleanType()}
        return T.StructType([T.StructField(c, kinds.get(t, T.StringType())) for c, t in self.columns.items()])


# The members of the two enumerated columns.
ELECTION_TYPES = (
    "N/A", "GENERAL", "PRIMARY", "RECALL", "SPECIAL ELECTION", "OFFICEHOLDER", "SPECIAL RUNOFF", "UNKNOWN",
)
PARTIES = (
    "N/A", "DEMOCRATIC", "REPUBLICAN", "GREEN PARTY", "REFORM PARTY", "AMERICAN INDEPENDENT PARTY",
    "PEACE AND FREEDOM", "INDEPENDENT", "LIBERTARIAN", "NON PARTISAN", "NATURAL LAW", "UNKNOWN",
    "NO PARTY PREFERENCE", "AMERICANS ELECT",
)

PERSON, FIRM, EMPLOYER = ("person", ("_id",)), ("lobbying_firm", ("organization_id",)), (
    "lobbyist_employer", ("organization_id",),
)
ACTIVITY, COMMITTEE, CANDIDATE = ("activity", ("_id",)), ("committee", ("organization_id",)), (
    "candidate", ("person_id",),
)
BALLOT = ("ballot", ("ballot_number", "legislative_session"))
DONOR = ("donor", ("_id",))
SPENDING = {
    "transaction_date": DATE, "monetary_amount": ID, "code": text(3), "description": text(255), "purpose": text(255),
}


def _link(fact: str, column: str) -> Table:
    return Table(
        {column: ID, "activity_id": ID}, (column, "activity_id"),
        parents={(column,): (fact, ("_id",)), ("activity_id",): ACTIVITY},
    )


def _committee_kind() -> Table:
    return Table({"committee_id": ID}, ("committee_id",), parents={("committee_id",): COMMITTEE})


# Names, types, widths and keys of the mart tables.
MART: dict[str, Table] = {
    "person": Table(
        {"_id": ID, "master_pid": ID, "first": text(45), "middle": text(45), "last": text(200),
         "suffix": text(10), "title": text(10)},
        ("_id",),
    ),
    "filer_id": Table(
        {"organization_id": ID, "person_id": ID, "filer_id": text(9)}, parents={("person_id",): PERSON}
    ),
    "activity": Table({"_id": ID, "activity": text(400), "filing_id": ID, "amendment_id": ID}, ("_id",)),
    "lobbyist": Table({"person_id": ID}, ("person_id",), parents={("person_id",): PERSON}),
    "lobbying_firm": Table({"organization_id": ID}, ("organization_id",)),
    "lobbyist_employer": Table({"organization_id": ID}, ("organization_id",)),
    "permanent_employment": Table(
        {"lobbyist_id": ID, "lobbying_firm_id": ID, "start": DATE, "end": DATE, "legislative_session": YEAR,
         "ethics_completion": DATE},
        ("lobbyist_id", "lobbying_firm_id", "start"),
        parents={("lobbyist_id",): ("lobbyist", ("person_id",)), ("lobbying_firm_id",): FIRM},
    ),
    "direct_employment": Table(
        {"_id": ID, "lobbyist_id": ID, "lobbyist_employer_id": ID, "start": DATE, "end": DATE,
         "legislative_session": YEAR, "ethics_completion": DATE},
        ("_id",), (("lobbyist_id", "lobbyist_employer_id", "start"),),
        ("lobbyist_id", "lobbyist_employer_id", "start"),
        {("lobbyist_id",): ("lobbyist", ("person_id",)), ("lobbyist_employer_id",): EMPLOYER},
    ),
    "employed_lobbying": _link("direct_employment", "employed_id"),
    "contract": Table(
        {"_id": ID, "lobbying_firm_id": ID, "lobbyist_employer_id": ID, "601_filing_id": ID,
         "601_amendment_id": ID, "filing_date": DATE, "effective_date": DATE,
         "period_of_contract": text(30), "legislative_session": YEAR},
        ("_id",), (("lobbying_firm_id", "lobbyist_employer_id", "filing_date", "effective_date"),),
        ("lobbying_firm_id", "lobbyist_employer_id", "filing_date", "effective_date"),
        {("lobbying_firm_id",): FIRM, ("lobbyist_employer_id",): EMPLOYER},
    ),
    "contracted_lobbying": _link("contract", "contract_id"),
    "subcontract": Table(
        {"_id": ID, "subcontracting_firm_id": ID, "subcontracted_firm_id": ID, "employer_id": ID,
         "601_filing_id": ID, "601_amendment_id": ID, "filing_date": DATE, "effective_date": DATE,
         "period_of_contract": text(30), "legislative_session": YEAR},
        ("_id",),
        (("subcontracting_firm_id", "subcontracted_firm_id", "employer_id", "filing_date", "effective_date"),),
        ("subcontracting_firm_id", "subcontracted_firm_id", "employer_id", "filing_date", "effective_date"),
        {("subcontracting_firm_id",): FIRM, ("subcontracted_firm_id",): FIRM, ("employer_id",): EMPLOYER},
    ),
    "subcontracted_lobbying": _link("subcontract", "subcontract_id"),
    "individual_lobbying": Table(
        {"organization_id": ID, "activity_id": ID, "filing_date": DATE, "legislative_session": YEAR},
        ("organization_id", "activity_id"), parents={("activity_id",): ACTIVITY},
    ),
    "district": Table(
        {"_id": ID, "chamber": text(50), "number": text(4)}, ("_id",), (("chamber", "number"),),
        ("chamber", "number"),
    ),
    "office": Table(
        {"_id": ID, "title": text(80), "agency": text(200), "jurisdiction": text(30), "district_id": ID},
        ("_id",), (("title", "agency", "jurisdiction"),), ("title", "agency", "jurisdiction"),
        {("district_id",): ("district", ("_id",))},
    ),
    "election": Table(
        {"office_id": ID, "type": text(16), "year": YEAR}, ("office_id", "type", "year"),
        parents={("office_id",): ("office", ("_id",))}, domains={"type": ELECTION_TYPES},
    ),
    "candidate": Table(
        {"person_id": ID, "party": text(26)}, ("person_id", "party"),
        parents={("person_id",): PERSON}, domains={"party": PARTIES},
    ),
    "running": Table(
        {"candidate_id": ID, "election_office_id": ID, "election_type": text(16), "election_year": YEAR,
         "501_filing_id": ID, "501_amendment_id": ID},
        ("candidate_id", "election_office_id", "election_type", "election_year"),
        parents={
            ("candidate_id",): CANDIDATE,
            ("election_office_id", "election_type", "election_year"): ("election", ("office_id", "type", "year")),
        },
        domains={"election_type": ELECTION_TYPES},
    ),
    "lawmaker": Table({"candidate_id": ID}, ("candidate_id",), parents={("candidate_id",): CANDIDATE}),
    "committee": Table({"organization_id": ID, "410_filing_id": ID, "410_amendment_id": ID}, ("organization_id",)),
    "controlled_committee": Table(
        {"committee_id": ID, "candidate_id": ID}, ("committee_id",),
        parents={("committee_id",): COMMITTEE, ("candidate_id",): CANDIDATE},
    ),
    "ballot_committee": _committee_kind(),
    "independent_committee": _committee_kind(),
    "general_committee": _committee_kind(),
    "ballot": Table(
        {"ballot_number": text(4), "legislative_session": YEAR, "name": text(200), "jurisdiction": text(40)},
        ("ballot_number", "legislative_session"),
    ),
    "ballot_support": Table(
        {"committee_id": ID, "ballot_number": text(4), "legislative_session": YEAR, "position": FLAG},
        ("committee_id", "ballot_number", "legislative_session"),
        parents={("committee_id",): COMMITTEE, ("ballot_number", "legislative_session"): BALLOT},
    ),
    "candidate_support": Table(
        {"committee_id": ID, "candidate_id": ID, "position": FLAG}, ("committee_id", "candidate_id"),
        parents={("committee_id",): COMMITTEE, ("candidate_id",): CANDIDATE},
    ),
    "expenditure": Table(
        {"460_filing_id": ID, "460_amendment_id": ID, "committee_id": ID, **SPENDING}, ("460_filing_id",),
        parents={("committee_id",): COMMITTEE},
    ),
    "donor": Table(
        {"_id": ID, "organization_id": ID, "person_id": ID}, ("_id",), (("person_id",), ("organization_id",)),
        parents={("person_id",): PERSON},
    ),
    "sponsorship": Table(
        {"organization_id": ID, "donor_id": ID, **SPENDING}, ("organization_id", "donor_id"),
        parents={("donor_id",): DONOR},
    ),
    "contribution": Table(
        {"460_filing_id": ID, "460_amendment_id": ID, "donor_id": ID, "committee_id": ID, "amount": ID,
         "classification": text(255)},
        ("460_filing_id",), (("donor_id", "committee_id"),),
        parents={("donor_id",): DONOR, ("committee_id",): COMMITTEE},
    ),
    "independent_expenditure_ballot": Table(
        {"461_filing_id": ID, "461_amendment_id": ID, "donor_id": ID, "ballot_number": text(4),
         "legislative_session": YEAR, **SPENDING},
        ("461_filing_id",), (("donor_id", "ballot_number", "legislative_session"),),
        parents={("donor_id",): DONOR, ("ballot_number", "legislative_session"): BALLOT},
    ),
    "independent_expenditure_candidate": Table(
        {"461_filing_id": ID, "461_amendment_id": ID, "donor_id": ID, "candidate_id": ID, **SPENDING},
        ("461_filing_id",), (("donor_id", "candidate_id"),),
        parents={("donor_id",): DONOR, ("candidate_id",): CANDIDATE},
    ),
}

# Raw filings: every column is text until parsed.
RAW: dict[str, tuple[str, ...]] = {
    "lobby_disclosure": (
        "filing_id", "amend_id", "form_type", "filer_id", "entity_cd", "filer_naml", "filer_namf", "filer_namt",
        "filer_nams", "firm_name", "firm_city", "firm_st", "lby_actvty", "from_date", "thru_date",
    ),
    "registration": (
        "filing_id", "amend_id", "form_type", "entity_cd", "filer_id", "filer_naml", "ls_beg_yr", "complet_dt",
    ),
    "payment_line": ("filing_id", "amend_id", "emplr_naml", "emplr_city", "emplr_st", "lby_actvty"),
    "employer_line": ("filing_id", "amend_id", "cli_naml", "cli_city", "cli_st", "eff_date", "con_period"),
    "subcontract_line": ("filing_id", "amend_id", "firm_name", "firm_city", "firm_st", "subj_naml"),
    "candidate_intention": (
        "filing_id", "amend_id", "filer_id", "form_type", "committee_id", "cand_naml", "cand_namf", "can_namm",
        "cand_namt", "cand_nams", "office_cd", "offic_dscr", "agency_nam", "juris_cd", "juris_dscr", "yr_of_elec",
        "elec_type", "party_cd", "party", "district_cd", "dist_no",
    ),
    "committee_statement": (
        "filing_id", "amend_id", "form_type", "filer_id", "entity_cd", "filer_naml", "city", "st", "cmtte_type",
        "control_yn", "bal_num", "bal_name", "bal_juris", "sup_opp_cd",
    ),
    "campaign_cover": ("filer_id", "from_date"),
}

MASTER: dict[str, str] = {
    "master_person": "pid bigint, first string, middle string, last string, source string",
    "master_org": "oid bigint, name string, city string, state string",
    "master_bill": "bid string, type string, number string, session_year int, state string",
}


def raw_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW[name]])


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A raw filing table with its declared columns.

    Parquet is read by name. Delimited dumps are read by their header line, upper case or not, and
    the declared columns selected, so only those are parsed.
    """
    if fmt == "parquet":
        return spark.read.schema(raw_schema(name)).options(**options).parquet(path)
    settings = {"header": True, "sep": "\t", **options}
    df = spark.read.options(**settings).csv(path)
    known = {c.lower(): c for c in df.columns}
    return df.select(*[df[f"`{known[c]}`"].cast("string").alias(c) for c in RAW[name]])


def read_master(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(MASTER[name]).parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=lower, upperBound=upper,
                 numPartitions=partitions, **options)
        .load()
    )


def empty_mart(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], MART[name].schema())


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select a mart table's columns in order and type; columns nobody filled are null."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in MART[name].schema()
        ]
    )
