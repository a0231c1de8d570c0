"""Filing-shaped frames over the benchmark tables, so that the operators can run on them.

Row-wise reshaping only: every frame grows with its tables. The operators know none of this.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.functions.text import FILING_TIMESTAMP, session_year

CORRUPT = "not a date"


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def filing_text(ts: Column) -> Column:
    return F.date_format(ts, FILING_TIMESTAMP)


def month_start(c: str) -> Column:
    return F.date_trunc("month", F.col(c)).cast("timestamp_ntz")


def month_end(c: str) -> Column:
    return F.last_day(F.col(c)).cast("timestamp_ntz")


def supplier_city(key: str) -> Column:
    """NATION_n, and for every fourth nation the place as one "CITY, ST" field."""
    return F.when(F.col(key) % 4 == 0, F.concat(F.lit("Nation_"), text(key), F.lit(", R"), text(F.col(key) % 5))).otherwise(
        F.concat(F.lit("Nation_"), text(key))
    )


def family_name() -> Column:
    """A family name for every four customers, so names repeat a little at any size of the table."""
    return F.concat(F.lit("FAM"), text(F.floor(F.col("c_custkey") / 4)))


class Filings:
    """The staging views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str, damaged: bool = False):
        self.spark = spark
        self.folder = folder
        self.damaged = damaged
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def covers(self) -> DataFrame:
        """Lobby disclosure covers: A lines are lobbyists' reports, N firms', R employers' and individuals'."""
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
                                           "l_returnflag", "l_linestatus")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        c = self.table("customer").select("c_custkey", "c_name", "c_mktsegment")
        # customers meet their orders before the lines do, so the lines move once less
        ordered = o.join(c, o.o_custkey == c.c_custkey)
        rows = li.join(ordered, li.l_orderkey == ordered.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
        form = (
            F.when(F.col("l_returnflag") == "A", "F615").when(F.col("l_returnflag") == "N", "F625")
            .when(F.col("l_linestatus") == "F", "F635").otherwise("F645")
        )
        person = form == "F615"
        odd = F.col("l_partkey") % 19 == 0  # a form filed under the other kind of entity
        entity = (
            F.when(person, "LBY").when(form == "F625", F.when(odd, "LEM").otherwise("FRM"))
            .when(form == "F635", F.when(odd, "FRM").when(F.col("l_suppkey") % 2 == 0, "LEM").otherwise("LCO"))
            .otherwise(F.element_at(F.array(F.lit("FRM"), F.lit("LEM"), F.lit("LCO")), (F.col("l_suppkey") % 3 + 1).cast("int")))
        )
        given, family = F.col("c_mktsegment"), family_name()
        no_first, swapped = F.col("l_linenumber") % 5 == 0, F.col("l_linenumber") % 7 == 0
        last = F.when(no_first, F.concat(given, F.lit(" "), family)).when(swapped, given).otherwise(family)
        first = (
            F.when(no_first, F.lit("")).when(swapped, family)
            .when(F.col("l_linenumber") % 2 == 0, F.concat(given, F.lit(" Q."))).otherwise(given)
        )
        return rows.select(
            text("l_orderkey").alias("filing_id"),
            text("l_linenumber").alias("amend_id"),
            form.alias("form_type"),
            F.when(person, F.concat(F.lit("L"), text("o_custkey"))).otherwise(text("l_suppkey")).alias("filer_id"),
            entity.alias("entity_cd"),
            F.when(person, last).otherwise(F.concat(F.lit(" "), F.col("s_name"))).alias("filer_naml"),
            F.when(person, first).when(F.col("l_suppkey") % 9 != 0, F.lit("The ")).alias("filer_namf"),
            F.lit("").alias("filer_namt"),
            F.lit("").alias("filer_nams"),
            F.concat(F.lit(" "), F.col("s_name")).alias("firm_name"),
            supplier_city("s_nationkey").alias("firm_city"),
            F.concat(F.lit("R"), text(F.col("s_nationkey") % 5)).alias("firm_st"),
            F.concat(
                F.lit("AB "), text("l_partkey"), F.lit(", "), text(F.col("l_quantity").cast("int")),
                F.lit(";SB "), text("l_suppkey"), F.lit(";NONE"),
            ).alias("lby_actvty"),
            F.when(F.col("l_partkey") % 23 == 0, F.lit(CORRUPT)).otherwise(filing_text(month_start("o_orderdate"))).alias("from_date"),
            filing_text(month_end("o_orderdate")).alias("thru_date"),
        )

    @cached_property
    def registrations(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus", "l_shipdate")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        s = self.table("supplier").select("s_suppkey", "s_name")
        rows = li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
        person = F.col("l_linestatus") == "F"
        return rows.select(
            text("l_orderkey").alias("filing_id"),
            text("l_linenumber").alias("amend_id"),
            F.when(person, "F604").otherwise("F601").alias("form_type"),
            F.when(person, "LBY").otherwise("FRM").alias("entity_cd"),
            F.when(person, F.concat(F.lit("L"), text("o_custkey"))).otherwise(text("l_suppkey")).alias("filer_id"),
            F.concat(F.lit(" "), F.col("s_name")).alias("filer_naml"),
            text(session_year(F.col("o_orderdate"))).alias("ls_beg_yr"),
            filing_text(F.col("l_shipdate")).alias("complet_dt"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        p = self.table("part").select("p_partkey", "p_name", "p_brand", "p_size")
        rows = li.join(p, li.l_partkey == p.p_partkey)
        return rows.select(
            text("l_orderkey").alias("filing_id"),
            text("l_linenumber").alias("amend_id"),
            F.col("p_name").alias("emplr_naml"),
            F.col("p_brand").alias("emplr_city"),
            F.concat(F.lit("S"), text("p_size")).alias("emplr_st"),
            F.concat(F.lit("AB "), text("l_partkey"), F.lit(";SB "), text("l_suppkey")).alias("lby_actvty"),
        )

    @cached_property
    def employers(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag")
        p = self.table("part").select("p_partkey", "p_name", "p_brand", "p_size")
        rows = li.join(p, li.l_partkey == p.p_partkey)
        return rows.select(
            text("l_orderkey").alias("filing_id"),
            text("l_linenumber").alias("amend_id"),
            F.col("p_name").alias("cli_naml"),
            F.col("p_brand").alias("cli_city"),
            F.concat(F.lit("S"), text("p_size")).alias("cli_st"),
            F.when(F.col("l_partkey") % 17 == 0, F.lit(CORRUPT)).otherwise(filing_text(F.col("l_shipdate"))).alias("eff_date"),
            F.col("l_returnflag").alias("con_period"),
        )

    @cached_property
    def subcontract_lines(self) -> DataFrame:
        li = self.table("lineitem").filter("l_quantity > 25").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        p = self.table("part").select("p_partkey", "p_name")
        s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        rows = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey + 1 == s.s_suppkey, "left")
        return rows.select(
            text("l_orderkey").alias("filing_id"),
            text("l_linenumber").alias("amend_id"),
            F.concat(F.lit(" "), F.col("s_name")).alias("firm_name"),
            supplier_city("s_nationkey").alias("firm_city"),
            F.concat(F.lit("R"), text(F.col("s_nationkey") % 5)).alias("firm_st"),
            F.col("p_name").alias("subj_naml"),
        )

    @cached_property
    def intentions(self) -> DataFrame:
        """Candidate intentions: three orders make the amendments of one filing."""
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        c = self.table("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
        rows = o.join(c, o.o_custkey == c.c_custkey)
        key, given, family = F.col("o_orderkey"), F.col("c_mktsegment"), family_name()
        office = (
            F.when(given == "BUILDING", "30013").when(given == "MACHINERY", "30012").when(given == "FURNITURE", "30009")
            .when(given == "AUTOMOBILE", "30002").otherwise("99999")
        )
        dotted = F.col("o_custkey") % 3 == 0
        return rows.select(
            text(F.floor(key / 3)).alias("filing_id"),
            text(key % 3 * 4 + 1).alias("amend_id"),
            F.concat(F.lit("C"), text("o_custkey")).alias("filer_id"),
            F.when(F.col("o_orderstatus") == "P", "F502").otherwise("F501").alias("form_type"),
            text(F.floor(F.col("o_custkey") / 15)).alias("committee_id"),
            F.when(key % 4 == 0, F.concat(family, F.lit(" JR."))).when(key % 4 == 2, F.concat(given, F.lit(" "), family))
            .otherwise(family).alias("cand_naml"),
            F.when(key % 4 == 2, F.lit("")).when((key % 4 == 1) & dotted, F.concat(given, F.lit(" Q."))).otherwise(given)
            .alias("cand_namf"),
            F.when(key % 5 == 0, F.lit("M")).otherwise(F.lit("")).alias("can_namm"),
            F.lit("").alias("cand_namt"),
            F.lit("").alias("cand_nams"),
            office.alias("office_cd"),
            F.when(key % 2 == 0, F.lit("")).when(given == "BUILDING", "ASSEMBLY").otherwise(F.lit("")).alias("offic_dscr"),
            F.when(F.col("c_nationkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("AGENCY "), text(F.col("c_nationkey") % 5)))
            .alias("agency_nam"),
            text(F.lit(40501) + F.col("c_nationkey") % 8).alias("juris_cd"),
            F.lit("").alias("juris_dscr"),
            text(F.year("o_orderdate")).alias("yr_of_elec"),
            text(F.lit(3000) + key % 9).alias("elec_type"),
            text(F.lit(16000) + key % 22).alias("party_cd"),
            F.when(key % 11 == 0, F.lit("Democratic")).when(key % 13 == 0, F.lit("Whig")).otherwise(F.lit("")).alias("party"),
            text(F.lit(17001) + F.col("o_custkey") % 95).alias("district_cd"),
            F.when(key % 3 == 0, F.lit("")).otherwise(text(F.col("c_nationkey"))).alias("dist_no"),
        )

    @cached_property
    def statements(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
                                           "l_returnflag", "l_linestatus")
        s = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        rows = li.join(s, li.l_suppkey == s.s_suppkey)
        flag, measure = F.col("l_returnflag"), text((F.col("l_quantity") * 250).cast("int"))
        return rows.select(
            text("l_orderkey").alias("filing_id"),
            text("l_linenumber").alias("amend_id"),
            F.lit("F410").alias("form_type"),
            F.concat(F.lit(" "), text("l_suppkey")).alias("filer_id"),
            F.element_at(F.array(*[F.lit(v) for v in ("CTL", "RCP", "BMC", "")]), (F.col("l_suppkey") % 4 + 1).cast("int"))
            .alias("entity_cd"),
            F.when(F.col("l_suppkey") % 10 == 7, F.lit("X")).otherwise(F.concat(F.col("s_name"), F.lit(" "))).alias("filer_naml"),
            F.concat(F.lit("Nation_"), text("s_nationkey")).alias("city"),
            F.concat(F.lit("R"), text(F.col("s_nationkey") % 5)).alias("st"),
            F.when(flag == "A", "C").when(flag == "N", "B").when(F.col("l_linestatus") == "F", "G").otherwise("P").alias("cmtte_type"),
            F.when(F.col("l_linenumber") % 4 == 0, "Y").otherwise("N").alias("control_yn"),
            measure.alias("bal_num"),
            F.concat(F.lit("MEASURE "), measure, F.lit(" ")).alias("bal_name"),
            F.when(F.col("l_partkey") % 9 != 0, F.concat(F.lit("DISTRICT "), text(F.col("l_partkey") % 7))).alias("bal_juris"),
            F.element_at(F.array(F.lit("S"), F.lit("s"), F.lit("O")), (F.col("l_linenumber") % 3 + 1).cast("int")).alias("sup_opp_cd"),
        )

    @cached_property
    def campaign_covers(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_suppkey")
        o = self.table("orders").select("o_orderkey", "o_orderdate")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            text("l_suppkey").alias("filer_id"),
            F.when(F.col("l_orderkey") % 23 == 0, F.lit(CORRUPT)).otherwise(filing_text(F.col("o_orderdate"))).alias("from_date")
        )

    @cached_property
    def master_org(self) -> DataFrame:
        """Suppliers, one of each name, and parts, whose names are shared by many."""
        s = self.table("supplier").select(
            F.col("s_suppkey").alias("oid"), F.col("s_name").alias("name"),
            F.concat(F.lit("NATION_"), text("s_nationkey")).alias("city"),
            F.concat(F.lit("R"), text(F.col("s_nationkey") % 5)).alias("state"),
        )
        p = self.table("part").select(
            (F.col("p_partkey") + 1_000_000_000).alias("oid"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("city"), F.concat(F.lit("S"), text("p_size")).alias("state"),
        )
        return s.unionByName(p)

    @cached_property
    def master_person(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.col("c_custkey").alias("pid"),
            F.col("c_mktsegment").alias("first"),
            F.when(F.col("c_nationkey") % 3 == 1, F.lit("Quincy")).when(F.col("c_nationkey") % 3 == 2, F.lit("Mary")).alias("middle"),
            family_name().alias("last"),
            F.when(F.col("c_nationkey") % 5 == 0, F.lit("TT_Lobbyist")).otherwise(F.lit("OTHER")).alias("source"),
        )

    def _damage(self, name: str, df: DataFrame) -> DataFrame:
        """Ids that are no numbers, blank names, missing years and filers without covers, by the filing's number."""
        if name == "campaign_cover":
            return df.withColumn("filer_id", F.when(F.col("filer_id").cast("bigint") % 5 == 1, F.concat(F.lit("Z"), "filer_id")).otherwise(F.col("filer_id")))
        no = F.col("_no")
        blank = lambda c: F.when(no % 17 == 4, "").otherwise(F.col(c))
        changes = {
            "filing_id": F.when(no % 11 == 3, F.concat(F.lit("E-"), "filing_id")).otherwise(F.col("filing_id")),
            "amend_id": F.when((no % 13 == 5) & (F.col("amend_id") == "1"), "x").otherwise(F.col("amend_id")),
            **{c: blank(c) for c in ("filer_naml", "filer_namf", "emplr_naml", "cli_naml", "subj_naml", "cand_naml", "cand_namf") if c in df.columns},
            **{c: F.when(no % 7 == 2, "none").otherwise(F.col(c)) for c in ("ls_beg_yr",) if c in df.columns},
            **{c: F.when(no % 19 == 6, "").otherwise(F.col(c)) for c in ("yr_of_elec",) if c in df.columns},
        }
        if name == "lobby_disclosure":
            changes["firm_name"] = F.when(no % 19 == 6, "").otherwise(F.col("firm_name"))
        return df.withColumn("_no", F.col("filing_id").cast("bigint")).withColumns(changes).drop("_no")

    def sources(self) -> dict[str, DataFrame]:
        """All views under the names the jobs ask for; built only when asked for."""
        made = self._views()
        if not self.damaged:
            return _Lazy(made)
        return _Lazy({n: (lambda n=n, make=make: make() if n.startswith("master_") else self._damage(n, make())) for n, make in made.items()})

    def _views(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "lobby_disclosure": lambda: self.covers,
            "registration": lambda: self.registrations,
            "payment_line": lambda: self.payments,
            "employer_line": lambda: self.employers,
            "subcontract_line": lambda: self.subcontract_lines,
            "candidate_intention": lambda: self.intentions,
            "committee_statement": lambda: self.statements,
            "campaign_cover": lambda: self.campaign_covers,
            "master_org": lambda: self.master_org,
            "master_person": lambda: self.master_person,
        }


class _Lazy(dict):
    """A dict of frames that are made on first access."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._makers[name]()
        return self[name]
