"""The staging views once more as SQL, written independently of the DataFrame code."""

TS = "'%-m/%-d/%Y %-I:%M:%S %p'"


def session(ts: str) -> str:
    return f"(year({ts}) - CASE WHEN year({ts}) % 2 = 0 THEN 1 ELSE 0 END)"


def parsed(c: str) -> str:
    return f"try_strptime({c}, '%m/%d/%Y %I:%M:%S %p')"


def place_city(c: str) -> str:
    return f"(CASE WHEN len(string_split({c}, ', ')) = 2 THEN string_split({c}, ', ')[1] ELSE {c} END)"


def place_state(c: str, st: str) -> str:
    return f"(CASE WHEN len(string_split({c}, ', ')) = 2 THEN string_split({c}, ', ')[2] ELSE {st} END)"


SUPPLIER_CITY = """(CASE WHEN s_nationkey % 4 = 0 THEN 'Nation_' || s_nationkey || ', R' || (s_nationkey % 5)
    ELSE 'Nation_' || s_nationkey END)"""

VIEWS = {
    "covers": f"""
    SELECT l_orderkey::VARCHAR AS filing_id, l_linenumber::VARCHAR AS amend_id, form_type,
        CASE WHEN form_type = 'F615' THEN 'L' || o_custkey ELSE l_suppkey::VARCHAR END AS filer_id,
        CASE form_type WHEN 'F615' THEN 'LBY' WHEN 'F625' THEN CASE WHEN l_partkey % 19 = 0 THEN 'LEM' ELSE 'FRM' END
            WHEN 'F635' THEN CASE WHEN l_partkey % 19 = 0 THEN 'FRM' WHEN l_suppkey % 2 = 0 THEN 'LEM' ELSE 'LCO' END
            ELSE CASE l_suppkey % 3 WHEN 0 THEN 'FRM' WHEN 1 THEN 'LEM' ELSE 'LCO' END END AS entity_cd,
        CASE WHEN form_type <> 'F615' THEN ' ' || s_name
            WHEN l_linenumber % 5 = 0 THEN c_mktsegment || ' ' || ('FAM' || (c_custkey // 4))
            WHEN l_linenumber % 7 = 0 THEN c_mktsegment ELSE ('FAM' || (c_custkey // 4)) END AS filer_naml,
        CASE WHEN form_type <> 'F615' THEN CASE WHEN l_suppkey % 9 <> 0 THEN 'The ' END
            WHEN l_linenumber % 5 = 0 THEN ''
            WHEN l_linenumber % 7 = 0 THEN ('FAM' || (c_custkey // 4))
            WHEN l_linenumber % 2 = 0 THEN c_mktsegment || ' Q.' ELSE c_mktsegment END AS filer_namf,
        ' ' || s_name AS firm_name, {SUPPLIER_CITY} AS firm_city, 'R' || (s_nationkey % 5) AS firm_st,
        'AB ' || l_partkey || ', ' || l_quantity::INT || ';SB ' || l_suppkey || ';NONE' AS lby_actvty,
        CASE WHEN l_partkey % 23 = 0 THEN 'not a date' ELSE strftime(date_trunc('month', o_orderdate), {TS}) END AS from_date,
        strftime(last_day(o_orderdate)::TIMESTAMP, {TS}) AS thru_date
    FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN 'F615' WHEN l_returnflag = 'N' THEN 'F625'
            WHEN l_linestatus = 'F' THEN 'F635' ELSE 'F645' END AS form_type FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey""",
    "registrations": f"""
    SELECT l_orderkey::VARCHAR AS filing_id, l_linenumber::VARCHAR AS amend_id,
        CASE WHEN l_linestatus = 'F' THEN 'F604' ELSE 'F601' END AS form_type,
        CASE WHEN l_linestatus = 'F' THEN 'LBY' ELSE 'FRM' END AS entity_cd,
        CASE WHEN l_linestatus = 'F' THEN 'L' || o_custkey ELSE l_suppkey::VARCHAR END AS filer_id,
        ' ' || s_name AS filer_naml, {session("o_orderdate")}::VARCHAR AS ls_beg_yr,
        strftime(l_shipdate, {TS}) AS complet_dt
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey""",
    "payments": """
    SELECT l_orderkey::VARCHAR AS filing_id, l_linenumber::VARCHAR AS amend_id, p_name AS emplr_naml,
        p_brand AS emplr_city, 'S' || p_size AS emplr_st, 'AB ' || l_partkey || ';SB ' || l_suppkey AS lby_actvty
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "employers": f"""
    SELECT l_orderkey::VARCHAR AS filing_id, l_linenumber::VARCHAR AS amend_id, p_name AS cli_naml,
        p_brand AS cli_city, 'S' || p_size AS cli_st,
        CASE WHEN l_partkey % 17 = 0 THEN 'not a date' ELSE strftime(l_shipdate, {TS}) END AS eff_date,
        l_returnflag AS con_period
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "subcontract_lines": f"""
    SELECT l_orderkey::VARCHAR AS filing_id, l_linenumber::VARCHAR AS amend_id, ' ' || s_name AS firm_name,
        {SUPPLIER_CITY} AS firm_city, 'R' || (s_nationkey % 5) AS firm_st, p_name AS subj_naml
    FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey + 1 = s_suppkey
    WHERE l_quantity > 25""",
    "intentions": """
    SELECT (o_orderkey // 3)::VARCHAR AS filing_id, (o_orderkey % 3 * 4 + 1)::VARCHAR AS amend_id,
        'C' || o_custkey AS filer_id, CASE WHEN o_orderstatus = 'P' THEN 'F502' ELSE 'F501' END AS form_type,
        (o_custkey // 15)::VARCHAR AS committee_id,
        CASE o_orderkey % 4 WHEN 0 THEN ('FAM' || (c_custkey // 4)) || ' JR.' WHEN 2 THEN c_mktsegment || ' ' || ('FAM' || (c_custkey // 4))
            ELSE ('FAM' || (c_custkey // 4)) END AS cand_naml,
        CASE WHEN o_orderkey % 4 = 2 THEN '' WHEN o_orderkey % 4 = 1 AND o_custkey % 3 = 0 THEN c_mktsegment || ' Q.'
            ELSE c_mktsegment END AS cand_namf,
        CASE WHEN o_orderkey % 5 = 0 THEN 'M' ELSE '' END AS can_namm,
        CASE c_mktsegment WHEN 'BUILDING' THEN '30013' WHEN 'MACHINERY' THEN '30012' WHEN 'FURNITURE' THEN '30009'
            WHEN 'AUTOMOBILE' THEN '30002' ELSE '99999' END AS office_cd,
        CASE WHEN o_orderkey % 2 <> 0 AND c_mktsegment = 'BUILDING' THEN 'ASSEMBLY' ELSE '' END AS offic_dscr,
        CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE 'AGENCY ' || (c_nationkey % 5) END AS agency_nam,
        (40501 + c_nationkey % 8)::VARCHAR AS juris_cd, '' AS juris_dscr,
        year(o_orderdate)::VARCHAR AS yr_of_elec, (3000 + o_orderkey % 9)::VARCHAR AS elec_type,
        (16000 + o_orderkey % 22)::VARCHAR AS party_cd,
        CASE WHEN o_orderkey % 11 = 0 THEN 'Democratic' WHEN o_orderkey % 13 = 0 THEN 'Whig' ELSE '' END AS party,
        (17001 + o_custkey % 95)::VARCHAR AS district_cd,
        CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE c_nationkey::VARCHAR END AS dist_no
    FROM orders JOIN customer ON o_custkey = c_custkey""",
    "statements": """
    SELECT l_orderkey::VARCHAR AS filing_id, l_linenumber::VARCHAR AS amend_id, 'F410' AS form_type,
        ' ' || l_suppkey AS filer_id,
        CASE l_suppkey % 4 WHEN 0 THEN 'CTL' WHEN 1 THEN 'RCP' WHEN 2 THEN 'BMC' ELSE '' END AS entity_cd,
        CASE WHEN l_suppkey % 10 = 7 THEN 'X' ELSE s_name || ' ' END AS filer_naml,
        'Nation_' || s_nationkey AS city, 'R' || (s_nationkey % 5) AS st,
        CASE WHEN l_returnflag = 'A' THEN 'C' WHEN l_returnflag = 'N' THEN 'B' WHEN l_linestatus = 'F' THEN 'G'
            ELSE 'P' END AS cmtte_type,
        CASE WHEN l_linenumber % 4 = 0 THEN 'Y' ELSE 'N' END AS control_yn,
        (l_quantity * 250)::INT::VARCHAR AS bal_num, 'MEASURE ' || (l_quantity * 250)::INT || ' ' AS bal_name,
        CASE WHEN l_partkey % 9 <> 0 THEN 'DISTRICT ' || (l_partkey % 7) END AS bal_juris,
        CASE l_linenumber % 3 WHEN 0 THEN 'S' WHEN 1 THEN 's' ELSE 'O' END AS sup_opp_cd
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "campaign_covers": f"""
    SELECT l_suppkey::VARCHAR AS filer_id, CASE WHEN l_orderkey % 23 = 0 THEN 'not a date' ELSE strftime(o_orderdate, {TS}) END AS from_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "master_org": """
    SELECT s_suppkey AS oid, upper(s_name) AS name, 'NATION_' || s_nationkey AS city, 'R' || (s_nationkey % 5) AS state
    FROM supplier
    UNION ALL
    SELECT p_partkey + 1000000000, upper(p_name), upper(p_brand), 'S' || p_size FROM part""",
    "master_person": """
    SELECT c_custkey AS pid, upper(c_mktsegment) AS first,
        CASE c_nationkey % 3 WHEN 1 THEN 'QUINCY' WHEN 2 THEN 'MARY' END AS middle,
        ('FAM' || (c_custkey // 4)) AS last, CASE WHEN c_nationkey % 5 = 0 THEN 'TT_Lobbyist' ELSE 'OTHER' END AS source
    FROM customer""",
}


def with_views(*names: str, **ctes: str) -> str:
    """A WITH clause of the named staging views followed by further CTEs."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n"


# what the damaged views replace, by the number of the filing
_BLANK = "CASE WHEN filing_id::BIGINT % 17 = 4 THEN '' ELSE {c} END AS {c}"
_IDS = ["CASE WHEN filing_id::BIGINT % 11 = 3 THEN 'E-' || filing_id ELSE filing_id END AS filing_id",
        "CASE WHEN filing_id::BIGINT % 13 = 5 AND amend_id = '1' THEN 'x' ELSE amend_id END AS amend_id"]
_YEAR = "CASE WHEN filing_id::BIGINT % 19 = 6 THEN '' ELSE {c} END AS {c}"
DAMAGE = {
    "covers": [*_IDS, _BLANK.format(c="filer_naml"), _BLANK.format(c="filer_namf"), _YEAR.format(c="firm_name")],
    "registrations": [*_IDS, _BLANK.format(c="filer_naml"), "CASE WHEN filing_id::BIGINT % 7 = 2 THEN 'none' ELSE ls_beg_yr END AS ls_beg_yr"],
    "payments": [*_IDS, _BLANK.format(c="emplr_naml")],
    "employers": [*_IDS, _BLANK.format(c="cli_naml")],
    "subcontract_lines": [*_IDS, _BLANK.format(c="subj_naml")],
    "intentions": [*_IDS, _BLANK.format(c="cand_naml"), _BLANK.format(c="cand_namf"), _YEAR.format(c="yr_of_elec")],
    "statements": [*_IDS, _BLANK.format(c="filer_naml")],
    "campaign_covers": ["CASE WHEN filer_id::BIGINT % 5 = 1 THEN 'Z' || filer_id ELSE filer_id END AS filer_id"],
}


def damaged_view(name: str) -> str:
    return f"SELECT * REPLACE ({', '.join(DAMAGE[name])}) FROM ({VIEWS[name]})"


def with_damaged(*names: str, usable: bool = False) -> str:
    """A WITH clause of the damaged views; only the rows whose ids are numbers if usable. Master data is never damaged."""
    good = "TRY_CAST(filing_id AS BIGINT) IS NOT NULL AND TRY_CAST(amend_id AS BIGINT) IS NOT NULL"
    parts = []
    for n in names:
        sql = damaged_view(n) if n in DAMAGE else VIEWS[n]
        parts.append(f"{n} AS ({f'SELECT * FROM ({sql}) WHERE {good}' if usable and n in DAMAGE and n != 'campaign_covers' else sql})")
    return "WITH " + ",\n".join(parts) + "\n"
