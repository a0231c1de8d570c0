"""Equivalent SQL for the registered queries, to be run on the same tables by a second engine."""

from __future__ import annotations

from filingloom.functions import codes
from filingloom.oracle_views import parsed, place_city, place_state, session, with_damaged, with_views

SQL: dict[str, str] = {}

STRIP = "regexp_replace(regexp_replace({c}, '^\\s+', ''), '\\s+$', '')"


def strip(c: str) -> str:
    return STRIP.format(c=c)


def key(c: str) -> str:
    return f"upper({strip(c)})"


def latest(source: str, where: str = "true", by: str = "filing_id", columns: str = "*") -> str:
    """Rows of the latest amendment, the filter applied first."""
    return f"""SELECT {columns} FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY amend_id::BIGINT DESC) AS rk
        FROM {source} WHERE {where}) WHERE rk = 1"""


def values(table: dict[str, str]) -> str:
    rows = ", ".join("('{}', '{}')".format(c, label.replace("'", "''")) for c, label in table.items())
    return f"(VALUES {rows}) AS t(code, label)"


# ---- latest amendments

SQL["latest_amendment_ties"] = """
SELECT * EXCLUDE (rk) FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS rk FROM lineitem)
WHERE rk = 1"""

SQL["latest_amendment_single"] = """
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey,
    l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
    l_shipdate) AS rk FROM lineitem) WHERE rk = 1"""

SQL["latest_then_filter"] = with_views("covers") + """
SELECT filing_id, amend_id, form_type, filer_id, lby_actvty FROM (
    SELECT *, rank() OVER (PARTITION BY filing_id ORDER BY amend_id::BIGINT DESC) AS rk FROM covers)
WHERE rk = 1 AND form_type = 'F615'"""

SQL["filter_then_latest"] = with_views("covers") + """
SELECT filing_id, amend_id, form_type, filer_id, lby_actvty FROM (
    SELECT *, rank() OVER (PARTITION BY filing_id ORDER BY amend_id::BIGINT DESC) AS rk FROM covers
    WHERE form_type = 'F615') WHERE rk = 1"""

SQL["latest_registration_per_session"] = f"""
SELECT o_custkey, ls::INT AS ls, o_orderkey FROM (SELECT o_custkey, {session("o_orderdate")} AS ls, o_orderkey,
    rank() OVER (PARTITION BY o_custkey, {session("o_orderdate")} ORDER BY o_orderkey DESC) AS rk FROM orders) WHERE rk = 1"""

# ---- text

SQL["session_years"] = f"""
WITH raw AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'not a date'
    ELSE strftime(o_orderdate, '%-m/%-d/%Y %-I:%M:%S %p') END AS r FROM orders)
SELECT o_orderkey, {session(parsed("r"))}::INT AS ls FROM raw"""

SQL["parse_dates"] = """
WITH raw AS (SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%-m/%-d/%Y %-I:%M:%S %p') AS good FROM orders),
shaped AS (SELECT o_orderkey, CASE o_orderkey % 17 WHEN 0 THEN 'not a date' WHEN 1 THEN ''
    WHEN 2 THEN '13/40/2016 1:00:00 AM' WHEN 3 THEN '0' || strftime(o_orderdate, '%-m/%-d/%Y') WHEN 4 THEN lower(good)
    WHEN 5 THEN replace(good, '12:00', '1:30') WHEN 6 THEN NULL ELSE good END AS raw FROM raw),
p AS (SELECT o_orderkey, try_strptime(upper(raw), '%m/%d/%Y %I:%M:%S %p') AS ts FROM shaped)
SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed, ts IS NULL AS missing FROM p"""

SQL["clean_text"] = f"""
SELECT doc_id, {key("chr(9) || ' ' || source || ' ' || chr(10)")} AS upper_stripped,
    {strip("chr(9) || ' ' || source || ' ' || chr(10)")} AS stripped, upper(source) AS upper_only,
    nullif(b, '') AS or_null, coalesce(nullif(b, ''), 'N/A') AS or_default,
    length(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)
        || chr(31) || chr(133) || chr(160)))::INT AS n_stripped
FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS b FROM documents)"""

RAW_NAMES = """raw AS (SELECT p_partkey,
    CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN p_name || '.' WHEN 2 THEN 'solo' ELSE ' ' || p_name END AS first,
    CASE p_partkey % 7 WHEN 0 THEN 'Q.' WHEN 1 THEN ' ' ELSE '' END AS middle,
    CASE p_partkey % 6 WHEN 0 THEN p_name || ' Jr.' WHEN 1 THEN p_brand || ' Sr. ' WHEN 2 THEN p_name || chr(9) || ' B.'
        ELSE p_name END AS last,
    CASE WHEN p_partkey % 4 = 0 THEN 'III' ELSE '' END AS suffix FROM part)"""


def tokens(c: str) -> str:
    return f"regexp_split_to_array({c}, '\\s+')"


def tail(c: str) -> str:
    """The last token, '' for a single one."""
    return f"(CASE WHEN len({tokens(c)}) > 1 THEN {tokens(c)}[-1] ELSE '' END)"


def head(c: str) -> str:
    """What stands before the last token, '' for a single one."""
    return f"(CASE WHEN len({tokens(c)}) > 1 THEN {strip(f'left({c}, length({c}) - length({tokens(c)}[-1]))')} ELSE '' END)"


def cleaned_names(source: str, first: str, middle: str, last: str, suffix: str, keep: str) -> str:
    """CTE bodies c1, c2: cleaned parts with the first name filled in."""
    return f"""c1 AS (SELECT {keep}, nullif({key(first)}, '') AS f0, nullif({key(middle)}, '') AS m0,
        nullif({key(last)}, '') AS l0, nullif({suffix}, '') AS s0 FROM {source}),
    c2 AS (SELECT * EXCLUDE (f0), coalesce(f0, {tokens("l0")}[1]) AS f0 FROM c1)"""


def always(keep: str) -> str:
    return f"""SELECT {keep}, CASE WHEN {head("f0")} <> '' THEN {head("f0")} ELSE f0 END AS first,
        CASE WHEN {head("f0")} <> '' THEN {tail("f0")} END AS middle, l0 AS last, s0 AS suffix FROM c2"""


def dotted(keep: str) -> str:
    return f"""SELECT {keep}, CASE WHEN way = 'first' THEN {head("f0")} ELSE f0 END AS first,
        CASE WHEN token IN ('JR.', 'SR.') THEN NULL ELSE coalesce(m0, token) END AS middle,
        CASE WHEN way = 'last' THEN {head("l0")} ELSE l0 END AS last,
        CASE WHEN token IN ('JR.', 'SR.') THEN token ELSE s0 END AS suffix
    FROM (SELECT *, CASE way WHEN 'last' THEN {tail("l0")} WHEN 'first' THEN {tail("f0")} END AS token
        FROM (SELECT *, CASE WHEN m0 IS NOT NULL THEN NULL
                WHEN l0 LIKE '%.' AND {head("l0")} <> '' THEN 'last'
                WHEN f0 LIKE '%.' AND {head("f0")} <> '' THEN 'first' END AS way FROM c2))"""


SQL["split_names"] = f"WITH {RAW_NAMES}, {cleaned_names('raw', 'first', 'middle', 'last', 'suffix', 'p_partkey')} " + always("p_partkey")
SQL["split_names_dotted"] = (
    f"WITH {RAW_NAMES}, {cleaned_names('raw', 'first', 'middle', 'last', 'suffix', 'p_partkey')} " + dotted("p_partkey")
)

SQL["split_place"] = f"""
WITH raw AS (SELECT s_suppkey, r_name, CASE s_suppkey % 4 WHEN 0 THEN n_name || ', ' || r_name
    WHEN 1 THEN n_name || ', x, ' || r_name WHEN 2 THEN n_name END AS c
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT s_suppkey, {place_city("c")} AS city, {place_state("c", "r_name")} AS state FROM raw"""

SQL["concat_nullable"] = """
SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_brand END || CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS org_name
FROM part"""

# ---- the filing queries

ETHICS = f"""ethics AS (SELECT filer_id, ls_beg_yr::INT AS ls, max({parsed("complet_dt")})::DATE AS ethics
    FROM ({latest("registrations", "form_type = 'F604' AND entity_cd = 'LBY'")}) GROUP BY ALL)"""

SQL["latest_ethics"] = with_views("registrations").rstrip() + f", {ETHICS} SELECT * FROM ethics"

def newest(source: str, where: str = "true") -> str:
    """Rows whose amendment is the highest of their filing among the rows that count."""
    return f"""SELECT s.* FROM {source} s SEMI JOIN (SELECT filing_id, max(amend_id::BIGINT) AS top FROM {source} WHERE {where}
        GROUP BY filing_id) m ON s.filing_id = m.filing_id AND s.amend_id::BIGINT = m.top WHERE {where}"""


# What organisations report is gathered per name and period, and each lobbyist's statement then looks its organisation up.
REGISTRATION_ROWS = f"""current_covers AS ({newest("covers")}),
{ETHICS},
reported AS (SELECT {key("filer_naml")} AS org_name, {parsed("from_date")}::DATE AS period_start,
        list(struct_pack(filing_id := filing_id, amend_id := amend_id, form_type := form_type, org_filer_id := filer_id,
            type := entity_cd, city := firm_city, state := firm_st, lby_actvty := lby_actvty,
            period_end := {parsed("thru_date")}::DATE)) AS reports
    FROM current_covers WHERE form_type IN ('F625', 'F635') AND entity_cd IN ('FRM', 'LEM', 'LCO') GROUP BY ALL),
stated AS (SELECT DISTINCT filer_id AS lb_filer_id, filer_naml AS last, filer_namf AS first, {key("firm_name")} AS org_name,
        {parsed("from_date")}::DATE AS period_start, {session(parsed("from_date"))}::INT AS ls
    FROM current_covers WHERE form_type = 'F615' AND entity_cd = 'LBY'),
reg AS (SELECT lb_filer_id, last, first, org_name, ls, ethics, r.*, period_start
    FROM (SELECT stated.*, (SELECT max(e.ethics) FROM ethics e WHERE e.filer_id = lb_filer_id AND e.ls = stated.ls) AS ethics,
            unnest(reports) AS r FROM stated JOIN reported USING (org_name, period_start) WHERE org_name <> ''))"""

SQL["registration_employment"] = with_views("covers", "registrations").rstrip() + f", {REGISTRATION_ROWS} SELECT * FROM reg"

# Clients are gathered per firm, session and name from the firm's newest registration; a payment finds its cover's firm and
# session by the filing, and then the clients.
ENGAGEMENTS = f"""firm AS (SELECT filing_id AS act_filing_id, amend_id AS act_amend_id, filer_id AS firm_filer_id,
        {key("filer_naml")} AS firm_name, firm_city, firm_st, {parsed("from_date")}::DATE AS filing_start,
        {session(parsed("from_date"))}::INT AS ls FROM ({newest("covers", "form_type = 'F625' AND entity_cd = 'FRM'")})),
enrolled AS (SELECT {key("filer_naml")} AS firm_name, ls_beg_yr::INT AS ls, filing_id, amend_id
    FROM ({newest("registrations", "form_type = 'F601' AND entity_cd = 'FRM'")})),
clients AS (SELECT n.firm_name, n.ls, {key("c.cli_naml")} AS emplr_name,
        list(struct_pack(reg_filing_id := n.filing_id, reg_amend_id := n.amend_id, cli_city := cli_city, cli_st := cli_st,
            eff_date := eff_date, con_period := con_period)) AS kept
    FROM enrolled n, ({newest("employers")}) c
    WHERE n.filing_id = c.filing_id AND n.filing_id::BIGINT = (SELECT max(o.filing_id::BIGINT) FROM enrolled o
        WHERE o.firm_name = n.firm_name AND o.ls = n.ls) AND {key("c.cli_naml")} <> ''
    GROUP BY ALL),
paying AS (SELECT filing_id AS act_filing_id, {key("emplr_naml")} AS emplr_name, lby_actvty FROM ({newest("payments")})),
passed AS (SELECT filing_id AS act_filing_id, {key("subj_naml")} AS emplr_name, {key("firm_name")} AS subfirm_name,
        firm_city AS subfirm_city, firm_st AS subfirm_st FROM ({newest("subcontract_lines")})),
engaged AS (SELECT * EXCLUDE (k), k.* FROM (SELECT act_filing_id, act_amend_id, firm_filer_id, firm_name, firm_city, firm_st,
        filing_start, ls, emplr_name, lby_actvty, unnest(kept) AS k
    FROM paying JOIN firm USING (act_filing_id) JOIN clients USING (firm_name, ls, emplr_name) WHERE firm_name <> ''))"""
ENGAGEMENT_VIEWS = ("covers", "registrations", "payments", "employers", "subcontract_lines")
CONTRACTS = """cont AS (SELECT * FROM engaged WHERE (act_filing_id, emplr_name) NOT IN (SELECT (act_filing_id, emplr_name) FROM passed
    WHERE act_filing_id IS NOT NULL AND emplr_name IS NOT NULL))"""
SUBCONTRACTS = """partners AS (SELECT firm_name AS subfirm_name, filing_start, count(*) AS n FROM firm GROUP BY ALL),
subcont AS (SELECT * EXCLUDE (n, times) FROM (SELECT *, unnest(range(n)) AS times
    FROM engaged JOIN passed USING (act_filing_id, emplr_name) JOIN partners USING (subfirm_name, filing_start)))"""

SQL["contracts_not_subcontracted"] = with_views(*ENGAGEMENT_VIEWS).rstrip() + f", {ENGAGEMENTS}, {CONTRACTS} SELECT * FROM cont"
SQL["contracts_with_bad_ids"] = (
    with_damaged(*ENGAGEMENT_VIEWS, usable=True).rstrip()
    + f", {ENGAGEMENTS.replace('ls_beg_yr::INT AS ls, filing_id, amend_id', 'TRY_CAST(ls_beg_yr AS INT) AS ls, filing_id, amend_id')}, {CONTRACTS} SELECT * FROM cont"
)
SQL["subcontracts"] = (
    with_views(*ENGAGEMENT_VIEWS).rstrip() + f", {ENGAGEMENTS}, {SUBCONTRACTS} SELECT * EXCLUDE (cli_city, cli_st) FROM subcont"
)

INDIVIDUALS = f"""ind AS (SELECT filing_id, amend_id, {strip("filer_id")} AS filer_id, entity_cd AS type,
    {key("filer_namf || filer_naml")} AS org_name, {place_city("upper(firm_city)")} AS city,
    {place_state("upper(firm_city)", "upper(firm_st)")} AS state, lby_actvty, {parsed("from_date")}::DATE AS filing_start,
    {session(parsed("from_date"))}::INT AS ls FROM ({latest("covers", "form_type = 'F645'")}))"""

SQL["individual_filings"] = with_views("covers").rstrip() + f", {INDIVIDUALS} SELECT * FROM ind"

# ---- entity resolution

PERSON_PROBES = """probe AS (SELECT o_orderkey, CASE WHEN o_orderkey % 31 = 0 THEN 'NOBODY' ELSE c_mktsegment END AS first,
    CASE o_orderkey % 6 WHEN 0 THEN 'Q.' WHEN 1 THEN 'MA' WHEN 2 THEN 'ZED' WHEN 3 THEN '.' END AS middle,
    'FAM' || (c_custkey // 4) AS last FROM orders JOIN customer ON o_custkey = c_custkey)"""


def person_tiers(source: str, row_id: str) -> str:
    """Every (probe, person) pair of one name, counted per tier; CTE `people_found`."""
    return f"""tiers AS (SELECT pr.{row_id}, count(m.pid) AS n, min(m.pid) AS one,
        count(m.pid) FILTER (WHERE m.source = 'TT_Lobbyist') AS n_pref,
        min(m.pid) FILTER (WHERE m.source = 'TT_Lobbyist') AS one_pref,
        count(m.pid) FILTER (WHERE fits) AS n_mid, min(m.pid) FILTER (WHERE fits) AS one_mid
    FROM (SELECT {row_id}, pr.first, pr.last, pr.middle, m.pid, m.source,
            (pr.middle IS NOT NULL AND starts_with(m.middle, rtrim(pr.middle, '.')))
            OR (pr.middle IS NULL AND coalesce(m.middle, '') = '') AS fits
        FROM {source} pr LEFT JOIN master_person m ON pr.first = m.first AND pr.last = m.last) pr
    , LATERAL (SELECT pr.pid AS pid, pr.source AS source) m GROUP BY 1),
    people_found AS (SELECT {row_id}, CASE WHEN n_mid = 1 THEN one_mid WHEN n_mid > 1 THEN NULL WHEN n = 1 THEN one
            WHEN n > 1 AND n_pref = 1 THEN one_pref END AS master_pid,
        CASE WHEN n_mid = 1 THEN 'middle' WHEN n_mid > 1 THEN 'ambiguous_middle' WHEN n = 1 THEN 'name' WHEN n = 0 THEN 'none'
            WHEN n_pref = 1 THEN 'preferred' ELSE 'ambiguous' END AS match_rule, n AS n_candidates FROM tiers)"""


SQL["person_cascade"] = (
    with_views("master_person").rstrip()
    + f", {PERSON_PROBES}, {person_tiers('probe', 'o_orderkey')}"
    + """ SELECT o_orderkey, first, middle, last, master_pid, match_rule, n_candidates
    FROM probe JOIN people_found USING (o_orderkey)"""
)
SQL["prefix_match"] = (
    with_views("master_person").rstrip()
    + f", {PERSON_PROBES}, {person_tiers('probe', 'o_orderkey')}"
    + """ SELECT o_orderkey, match_rule, master_pid FROM people_found WHERE match_rule IN ('middle', 'ambiguous_middle')"""
)

ORG_ROWS = f"""org_rows AS (SELECT {key('''CASE l_orderkey % 5 WHEN 0 THEN ' ' || s_name
        WHEN 3 THEN 'Unheard of ' || l_partkey WHEN 4 THEN CASE WHEN l_partkey % 2 = 0 THEN 'x' ELSE 'None ' END
        ELSE p_name END''')} AS org_name,
    CASE WHEN l_partkey % 4 <> 0 THEN l_suppkey::VARCHAR ELSE '' END AS filer_id,
    CASE WHEN l_orderkey % 2 = 0 THEN 'FRM' ELSE 'LEM' END AS type,
    upper(CASE WHEN l_orderkey % 5 = 2 THEN 'elsewhere' ELSE p_brand END) AS city, 'S' || p_size AS state,
    l_orderkey AS filing_no, l_linenumber AS amend_no
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def org_probe(rows: str, order: str) -> str:
    """CTE `org_probe`: the first row of each (name, filer, type)."""
    return f"""org_probe AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org_name, filer_id, type
        ORDER BY {order}, city NULLS FIRST, state NULLS FIRST) AS rn FROM {rows}) WHERE rn = 1)"""


def org_found(probe: str, order: str, filer: str = "NULL") -> str:
    """CTEs `org_rule` and `org_found`: the cascade by brute force over all organisations of a name."""
    return f"""named_orgs AS (SELECT name, count(DISTINCT oid) AS n, min(oid) AS one, list(struct_pack(oid := oid, city := city,
            state := state)) AS places FROM master_org GROUP BY name),
    org_places AS (SELECT p.org_name, p.filer_id, p.type, p.city, p.state, {order}, {filer} AS known_filer, coalesce(n, 0) AS n, one,
        list_distinct([x.oid for x in places if x.city = p.city or x.state = p.state]) AS near
        FROM {probe} p LEFT JOIN named_orgs ON name = org_name),
    org_counts AS (SELECT *, coalesce(len(near), 0) AS n_place, list_min(near) AS one_place FROM org_places),
    org_rule AS (SELECT *, CASE WHEN known_filer IS NOT NULL THEN 'filer'
        WHEN length(org_name) < 1 OR org_name IN ('X', 'XX', 'XXX', 'NONE', 'N/A', 'NA', 'UNKNOWN', 'TBD', '.', '-') THEN 'placeholder'
        WHEN n = 1 THEN 'name' WHEN n > 1 AND n_place = 1 THEN 'name_place' WHEN n > 1 THEN 'new_ambiguous' ELSE 'new' END
        AS match_rule FROM org_counts),
    org_made AS (SELECT *, CASE match_rule WHEN 'new' THEN org_name
        WHEN 'new_ambiguous' THEN org_name || '~' || coalesce(city, '~') || '~' || coalesce(state, '~')
        WHEN 'placeholder' THEN CASE WHEN filer_id <> '' THEN '~filer~' || filer_id
            ELSE org_name || '~' || coalesce(city, '~') || '~' || coalesce(state, '~') END END AS made FROM org_rule),
    org_found AS (SELECT org_name, filer_id, type, match_rule, n AS n_candidates, {order}, CASE
        WHEN match_rule = 'filer' THEN 'oid:' || known_filer WHEN match_rule = 'name' THEN 'oid:' || one
        WHEN match_rule = 'name_place' THEN 'oid:' || one_place
        ELSE 'new|' || first(org_name) OVER w || '|' || coalesce(first(city) OVER w, '') || '|'
            || coalesce(first(state) OVER w, '') END AS org
        FROM org_made WINDOW w AS (PARTITION BY made ORDER BY {order}, org_name, city NULLS FIRST, state NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


ORG_ORDER = "filing_no, amend_no"
ORG_CASCADE = (
    with_views("master_org").rstrip()
    + f", {ORG_ROWS}, {org_probe('org_rows', ORG_ORDER)}, {org_found('org_probe', ORG_ORDER)} "
)
SQL["org_cascade"] = ORG_CASCADE + "SELECT org_name, filer_id, type, org, match_rule, n_candidates FROM org_found"
SQL["unmatched_report"] = ORG_CASCADE + "SELECT match_rule, count(*) AS n FROM org_found GROUP BY ALL"
SQL["org_xref_rerun"] = ORG_CASCADE + "SELECT org_name, filer_id, type, org, 'cache' AS match_rule FROM org_found"


def org_by_filer(rows: str, order: str, known: str) -> str:
    """CTEs up to `org_of_filer`: the cascade over each filer's first probe, blank filers by name."""
    return f"""{org_probe(rows, order)},
    lead_probe AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN filer_id = '' THEN org_name || '~' || type
        ELSE filer_id END, filer_id = '' ORDER BY {order}, org_name, type, city NULLS FIRST, state NULLS FIRST) AS lead
        FROM org_probe) WHERE lead = 1),
    {org_found('lead_probe', order, known)},
    org_of_filer AS (SELECT p.org_name, p.filer_id, p.type, f.org, f.match_rule FROM org_probe p JOIN org_found f
        ON p.filer_id = f.filer_id WHERE p.filer_id <> ''
    UNION ALL SELECT org_name, filer_id, type, org, match_rule FROM org_found WHERE filer_id = '')"""


SQL["org_by_filer_first"] = f"""
WITH {ORG_ROWS}
SELECT DISTINCT org_name, filer_id, type, 'oid:' || (filer_id::BIGINT + 5000000) AS org, 'filer' AS match_rule FROM org_rows
WHERE filer_id <> '' AND TRY_CAST(filer_id AS BIGINT) % 2 = 0"""
# the first probe of each filer that has no organisation is resolved as any other, and its names take the outcome
SQL["org_by_filer_cascade"] = (
    with_views("master_org").rstrip()
    + f""", {ORG_ROWS}, {org_probe("org_rows", ORG_ORDER)},
open_probe AS (SELECT * FROM org_probe WHERE filer_id = '' OR TRY_CAST(filer_id AS BIGINT) % 2 <> 0),
first_of AS (SELECT filer_id, min(row(filing_no, amend_no, org_name, type)) AS k FROM open_probe WHERE filer_id <> '' GROUP BY filer_id),
lead_probe AS (SELECT p.* FROM open_probe p JOIN first_of f ON p.filer_id = f.filer_id AND row(p.filing_no, p.amend_no, p.org_name, p.type) = f.k
    UNION ALL SELECT * FROM open_probe WHERE filer_id = ''),
{org_found("lead_probe", ORG_ORDER)}
SELECT p.org_name, p.filer_id, p.type, f.org, f.match_rule FROM open_probe p JOIN org_found f ON p.filer_id = f.filer_id WHERE p.filer_id <> ''
UNION ALL SELECT org_name, filer_id, type, org, match_rule FROM org_found WHERE filer_id = ''"""
)


def walk(rows: str, scope: str, order: str) -> str:
    """CTEs `numbered`, `walk`: each scope's rows one by one, with the people known so far."""
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY {scope} ORDER BY {order}) AS rn FROM {rows}
        WHERE {scope} <> ''),
    walk({scope}, rn, known) AS (
        SELECT {scope}, rn, [first] FROM numbered WHERE rn = 1
        UNION ALL
        SELECT n.{scope}, n.rn, CASE WHEN list_contains(w.known, n.first) OR list_contains(w.known, coalesce(n.last, ''))
            THEN w.known ELSE list_append(w.known, n.first) END
        FROM walk w JOIN numbered n ON n.{scope} = w.{scope} AND n.rn = w.rn + 1),
    walked AS (SELECT n.*, list_filter(w.known, lambda x: x = n.first OR x = coalesce(n.last, ''))[1] AS anchor_first
        FROM numbered n JOIN walk w ON n.{scope} = w.{scope} AND n.rn = w.rn)"""


SQL["within_run_identity"] = f"""
WITH RECURSIVE ev AS (SELECT event_id, CASE WHEN user_id % 20 = 0 THEN '' ELSE user_id::VARCHAR END AS filer_id,
    CASE WHEN event_id % 11 = 0 THEN event_type || 'x' ELSE event_type END AS first,
    CASE event_id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'family' WHEN 3 THEN 'error' ELSE 'clickx' END AS last
    FROM events),
{walk("ev", "filer_id", "event_id")}
SELECT event_id, filer_id, first, last, anchor_first, NULL::VARCHAR AS anchor_last FROM walked
UNION ALL SELECT event_id, filer_id, first, last, first, last FROM ev WHERE filer_id = ''"""

PEOPLE_EVENTS = """incoming AS (SELECT event_id, user_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS first,
    CASE WHEN event_id % 5 = 0 THEN 'M' || (event_id % 7) END AS middle,
    CASE WHEN event_id % 2 = 0 THEN 'L' || (event_id % 4) END AS last FROM events),
stored AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM incoming)
    WHERE rn = 1)"""

SQL["fill_missing"] = f"""
WITH {PEOPLE_EVENTS},
found AS (SELECT user_id, {", ".join(f"arg_min({c}, event_id) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("first", "middle", "last"))}
    FROM incoming GROUP BY user_id)
SELECT s.event_id, s.user_id, coalesce(s.first, f.first) AS first, coalesce(s.middle, f.middle) AS middle,
    coalesce(s.last, f.last) AS last FROM stored s JOIN found f USING (user_id)"""

SQL["name_conflicts"] = f"""
WITH {PEOPLE_EVENTS}
""" + " UNION ALL ".join(
    f"""SELECT DISTINCT i.user_id, '{c}' AS field, s.{c} AS stored, i.{c} AS incoming FROM incoming i JOIN stored s USING (user_id)
    WHERE s.{c} IS DISTINCT FROM i.{c}""" for c in ("first", "middle", "last")
)

# ---- mart building

SQL["first_wins_insert"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) l
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P' AND o_orderkey = l_orderkey AND l_linenumber = 1)"""

SQL["insert_or_reject"] = """
WITH rows AS (SELECT l_suppkey AS firm, l_partkey % 40 AS employer,
    CASE WHEN l_partkey % 17 <> 0 THEN date_trunc('month', l_shipdate)::DATE END AS effective_date, l_orderkey AS filing_no
    FROM lineitem),
numbered AS (SELECT *, row_number() OVER (PARTITION BY firm, employer, effective_date ORDER BY filing_no) AS rn FROM rows),
decided AS (SELECT *, CASE WHEN effective_date IS NULL THEN 'no effective date' WHEN rn = 1 THEN 'accepted' ELSE 'duplicate' END
    AS reason FROM numbered)
SELECT firm, employer, effective_date, filing_no, reason, count(*) AS copies FROM decided GROUP BY ALL"""

SQL["lookup_or_insert_keys"] = """
SELECT o_custkey, o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') = 0 AS is_new,
    max(o_custkey) FILTER (WHERE o_orderstatus = 'F') AS stored_id, count(*) FILTER (WHERE o_orderstatus = 'F') = 0 AS made_unique
FROM orders GROUP BY o_custkey, o_orderpriority"""

SQL["filer_bridge"] = """
SELECT NULL::BIGINT AS organization_id, c_custkey AS person_id, 'C' || c_custkey AS filer_id FROM customer WHERE c_custkey % 10 <> 0
UNION SELECT l_suppkey, NULL, l_suppkey::VARCHAR FROM lineitem WHERE l_suppkey % 7 <> 0"""

SQL["subtype_routing"] = """
SELECT DISTINCT 'controlled' AS subtype, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'P'
UNION ALL SELECT DISTINCT CASE o_orderpriority WHEN '2-HIGH' THEN 'ballot' WHEN '4-NOT SPECIFIED' THEN 'independent'
    ELSE 'general' END, o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT'"""

SQL["role_unpivot_resolve"] = with_views("master_org").rstrip() + f""",
lines AS (SELECT l_orderkey, l_linenumber, upper(s_name) AS firm, l_suppkey, upper(p_name) AS employer, upper(p_brand) AS city,
    'S' || p_size AS state FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
org_rows AS (SELECT employer AS org_name, '' AS filer_id, 'LEM' AS type, city, state, l_orderkey, l_linenumber FROM lines),
{org_probe("org_rows", "l_orderkey, l_linenumber")}, {org_found("org_probe", "l_orderkey, l_linenumber")}
SELECT lines.l_orderkey, lines.l_linenumber, firm, employer, l_suppkey AS firm_id,
    CASE WHEN org LIKE 'oid:%' THEN substr(org, 5)::BIGINT END AS employer_id
FROM lines JOIN org_found ON employer = org_name"""

SQL["link_table"] = """
SELECT DISTINCT o_custkey AS employed_id, l_suppkey * 10 + month(l_shipdate) AS activity_id
FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""

SQL["add_parties"] = """
WITH p AS (SELECT o_custkey AS person_id, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS parties
    FROM orders GROUP BY 1)
SELECT DISTINCT o_custkey AS person_id, o_orderpriority AS party, parties FROM orders JOIN p ON o_custkey = person_id
WHERE o_orderpriority <> '1-URGENT'"""


def label(table: dict[str, str], code: str, text: str = "NULL") -> str:
    return f"coalesce(nullif({text}, ''), (SELECT label FROM {values(table)} WHERE code = {code}), 'N/A')"


SQL["code_lookup"] = with_views("intentions") + f"""
SELECT filing_id, amend_id, {label(codes.OFFICE, "office_cd", "offic_dscr")} AS office_cd_label,
    {label(codes.JURISDICTION, "juris_cd")} AS juris_cd_label, {label(codes.ELECTION, "elec_type")} AS elec_type_label,
    {label(codes.DISTRICT, "district_cd")} AS district_cd_label FROM intentions"""

PARTY_LIST = "({})".format(", ".join(f"'{p}'" for p in (
    "N/A", "DEMOCRATIC", "REPUBLICAN", "GREEN PARTY", "REFORM PARTY", "AMERICAN INDEPENDENT PARTY", "PEACE AND FREEDOM",
    "INDEPENDENT", "LIBERTARIAN", "NON PARTISAN", "NATURAL LAW", "UNKNOWN", "NO PARTY PREFERENCE", "AMERICANS ELECT",
)))
SAID = f"upper({label(codes.PARTY, 'party_cd', 'party')})"
SQL["party_lookup"] = with_views("intentions") + f"""
SELECT filing_id, amend_id, CASE WHEN {SAID} IN {PARTY_LIST} THEN {SAID} ELSE 'N/A' END AS party, {SAID} AS party_given
FROM intentions"""

SQL["json_side_output"] = with_views("master_person") + """
SELECT pid AS _id, NULL::BIGINT AS master_pid, first, middle, last FROM master_person"""

MENTIONS = """SELECT {keep}, split_part(g, ' ', 1) AS bill_type, trim(unnest(string_split(substr(g, strpos(g, ' ') + 1), ','))) AS number
    FROM (SELECT {keep}, trim(unnest(string_split(lby_actvty, ';'))) AS g FROM covers) WHERE strpos(g, ' ') > 0"""
SQL["bill_mentions"] = with_views("covers") + MENTIONS.format(keep="filing_id, amend_id")
SQL["bill_coverage"] = with_views("covers").rstrip() + f""",
m AS ({MENTIONS.format(keep=f'filing_id, {session(parsed("from_date"))} AS ls').replace(f'SELECT filing_id, {session(parsed("from_date"))} AS ls, split', 'SELECT filing_id, ls, split')})
SELECT bill_type, count(*) AS mentions, count(p_partkey) AS matched FROM m LEFT JOIN part
    ON number = p_partkey::VARCHAR AND ls = 1997 AND bill_type = CASE WHEN p_partkey % 2 = 0 THEN 'AB' ELSE 'SB' END
GROUP BY ALL"""

SQL["contract_violations"] = """
WITH rows AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, p_size, CASE WHEN p_size % 10 <> 0 THEN p_brand END AS brand,
    l_orderkey || '|' || l_linenumber AS k FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT 'primary' AS "check", 'line' AS "table", k AS "key", 'l_orderkey,l_linenumber' AS detail, count(*) AS n FROM rows GROUP BY k HAVING count(*) > 1
UNION ALL SELECT 'unique', 'line', l_orderkey || '|' || l_partkey, 'l_orderkey,l_partkey', count(*) FROM rows GROUP BY 3 HAVING count(*) > 1
UNION ALL SELECT 'required', 'line', k, 'brand', count(*) FROM rows WHERE brand IS NULL GROUP BY k
UNION ALL SELECT 'width', 'line', k, 'brand', count(*) FROM rows WHERE length(brand) > 7 GROUP BY k
UNION ALL SELECT 'domain', 'line', k, 'l_returnflag', count(*) FROM rows WHERE l_returnflag = 'R' GROUP BY k
UNION ALL SELECT 'parent', 'line', l_partkey::VARCHAR, 'l_partkey->small_part', count(*) FROM rows WHERE p_size > 40 GROUP BY l_partkey
UNION ALL SELECT 'parent', 'line', l_orderkey || '|' || l_returnflag, 'l_orderkey,l_returnflag->flagged', count(*) FROM rows
    JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'A' OR o_orderstatus = 'P' GROUP BY 3"""

# ---- jobs


def people_sql(rows: str, kind_order: str) -> str:
    """CTEs `person` and `of_row`: identity by walking the rows, then stored values and master match.

    `rows` has person_filer, first, middle, last, suffix and the order columns.
    """
    return f"""{walk(rows, "person_filer", kind_order)},
    firsts AS (SELECT *, row_number() OVER (PARTITION BY person_filer, anchor_first ORDER BY rn) AS nth FROM walked),
    stored AS (SELECT row_number() OVER () AS pno, * FROM firsts WHERE nth = 1),
    filled AS (SELECT person_filer, anchor_first, arg_min(middle, rn) FILTER (WHERE middle IS NOT NULL) AS any_middle,
        arg_min(last, rn) FILTER (WHERE last IS NOT NULL) AS any_last FROM walked GROUP BY ALL),
    {person_tiers("stored", "pno")},
    person AS (SELECT s.person_filer, s.anchor_first, s.first AS p_first, coalesce(s.middle, f.any_middle) AS p_middle,
        coalesce(s.last, f.any_last) AS p_last, s.suffix AS p_suffix, pf.master_pid AS p_master
        FROM stored s JOIN filled f USING (person_filer, anchor_first) JOIN people_found pf USING (pno))"""


# the columns a job's rows are distinct on, then ordered by; nulls first as in the engine under test
REG_FACTS = f"""{REGISTRATION_ROWS},
    {cleaned_names("reg", "first", "NULL::VARCHAR", "last", "NULL::VARCHAR",
                   "* EXCLUDE (first, last, city, state), " + place_city("upper(nullif(city, ''))") + " AS city, "
                   + place_state("upper(nullif(city, ''))", "upper(nullif(state, ''))") + " AS state")},
    facts AS (SELECT DISTINCT * EXCLUDE (filing_id, amend_id, lb_filer_id, org_filer_id), lb_filer_id AS person_filer,
        org_filer_id AS filer_id, filing_id::BIGINT AS filing_no, amend_id::BIGINT AS amend_no
        FROM ({always("* EXCLUDE (f0, m0, l0, s0)")}))"""
REG_ORDER = "filing_no, amend_no, first, last, middle NULLS FIRST, suffix NULLS FIRST"
REGISTRATION_MART = (
    with_views("covers", "registrations", "master_org", "master_person").replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + f""", {REG_FACTS}, {people_sql("facts", REG_ORDER)},
    {org_probe("facts", ORG_ORDER)}, {org_found("org_probe", ORG_ORDER)},
    employed AS (SELECT w.*, o.org FROM walked w JOIN org_found o ON w.org_name = o.org_name AND w.filer_id = o.filer_id
        AND w.type = o.type WHERE (w.form_type = 'F625') = (w.type = 'FRM'))"""
)
SQL["employment_mart"] = REGISTRATION_MART + """
SELECT CASE form_type WHEN 'F625' THEN 'firm' ELSE 'employer' END AS kind, org, e.person_filer, p_first, p_middle, p_last, p_suffix,
    p_master, period_start, period_end, ls AS legislative_session, ethics AS ethics_completion
FROM (SELECT *, row_number() OVER (PARTITION BY form_type, person_filer, anchor_first, org, period_start
    ORDER BY filing_no, amend_no, period_end NULLS FIRST, ls NULLS FIRST, ethics NULLS FIRST) AS nth2 FROM employed) e
JOIN person p ON e.person_filer = p.person_filer AND e.anchor_first = p.anchor_first WHERE nth2 = 1"""
SQL["employed_lobbying_mart"] = REGISTRATION_MART + """,
acts AS (SELECT * FROM (SELECT filing_no, amend_no, lby_actvty, row_number() OVER (PARTITION BY filing_no
    ORDER BY amend_no, lby_actvty) AS nth3 FROM employed WHERE form_type = 'F635') WHERE nth3 = 1)
SELECT DISTINCT e.person_filer, p_first, org, period_start, a.lby_actvty AS activity, a.filing_no AS filing_id, a.amend_no AS amendment_id
FROM employed e JOIN person p ON e.person_filer = p.person_filer AND e.anchor_first = p.anchor_first
JOIN acts a ON a.filing_no = e.filing_no WHERE form_type = 'F635'"""

AGREEMENT_FACTS = """facts AS (SELECT DISTINCT * EXCLUDE (reg_filing_id, reg_amend_id, act_filing_id, act_amend_id, eff_date),
    reg_filing_id::BIGINT AS reg_filing_no, reg_amend_id::BIGINT AS reg_amend_no, act_filing_id::BIGINT AS act_filing_no,
    act_amend_id::BIGINT AS act_amend_no, {date}::DATE AS effective_date FROM {rows})"""
AGREEMENT_ORDER = "reg_filing_no, reg_amend_no, act_filing_no, act_amend_no"


def role(kind: str, name: str, filer: str, city: str, state: str) -> str:
    up_city, up_state = f"upper(nullif({city}, ''))", f"upper(nullif({state}, ''))"
    return f"""SELECT {name} AS org_name, {filer} AS filer_id, '{kind}' AS type, {place_city(up_city)} AS city,
        {place_state(up_city, up_state)} AS state, {AGREEMENT_ORDER} FROM facts"""


def agreements(rows_cte: str, rows: str, role_sql: list[str], parties: dict[str, str]) -> str:
    """The contract and subcontract marts: roles resolved, then first per key accepted."""
    joins = " ".join(
        f"JOIN org_found {c[0]}{i} ON {on.format(t=f'{c[0]}{i}')}" for i, (c, on) in enumerate(parties.items())
    )
    names = ", ".join(f"{c[0]}{i}.org AS {c}" for i, c in enumerate(parties))
    keys = ", ".join(parties)
    return (
        with_views(*ENGAGEMENT_VIEWS, "master_org").rstrip()
        + f""", {ENGAGEMENTS}, {rows_cte}, {AGREEMENT_FACTS.format(rows=rows, date=parsed("eff_date"))},
        roles AS ({" UNION ALL ".join(role_sql)}),
        {org_probe("roles", AGREEMENT_ORDER)}, {org_found("org_probe", AGREEMENT_ORDER)},
        agreed AS (SELECT {names}, f.{AGREEMENT_ORDER.replace(", ", ", f.")}, filing_start AS filing_date, effective_date,
            con_period AS period_of_contract, ls AS legislative_session, lby_actvty FROM facts f {joins}),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys}, filing_date, effective_date ORDER BY {AGREEMENT_ORDER},
            period_of_contract, legislative_session, lby_actvty) AS nth FROM agreed),
        decided AS (SELECT *, CASE WHEN effective_date IS NULL THEN 'no effective date' WHEN nth = 1 THEN 'accepted'
            ELSE 'duplicate' END AS reason FROM ranked)
        SELECT {keys}, reg_filing_no AS filing_601, reg_amend_no AS amendment_601, filing_date, effective_date, period_of_contract,
            legislative_session, lby_actvty AS activity, act_filing_no AS act_filing, reason, sum(copies)::BIGINT AS copies
        FROM (SELECT *, 1 AS copies FROM decided)
        GROUP BY {keys}, {AGREEMENT_ORDER}, filing_date, effective_date, period_of_contract, legislative_session, lby_actvty, reason"""
    )


BY_FIRM = "{t}.type = 'FRM' AND {t}.org_name = f.firm_name AND {t}.filer_id = f.firm_filer_id"
BY_CLIENT = "{t}.type = 'LEM' AND {t}.org_name = f.emplr_name"
BY_SUBFIRM = "{t}.type = 'SFRM' AND {t}.org_name = f.subfirm_name"
FIRM_ROLE = role("FRM", "firm_name", "firm_filer_id", "firm_city", "firm_st")

SQL["contract_mart"] = agreements(
    CONTRACTS, "cont", [FIRM_ROLE, role("LEM", "emplr_name", "''", "cli_city", "cli_st")],
    {"lobbying_firm_org": BY_FIRM, "lobbyist_employer_org": BY_CLIENT},
)
SQL["subcontract_mart"] = agreements(
    SUBCONTRACTS, "(SELECT * EXCLUDE (cli_city, cli_st) FROM subcont)",
    [FIRM_ROLE, role("SFRM", "subfirm_name", "''", "subfirm_city", "subfirm_st"),
     role("LEM", "emplr_name", "''", "NULL::VARCHAR", "NULL::VARCHAR")],
    {"subcontracting_firm_org": BY_FIRM, "subcontracted_firm_org": BY_SUBFIRM, "employer_org": BY_CLIENT},
)

SQL["individual_mart"] = with_views("covers", "master_org").rstrip() + f""", {INDIVIDUALS},
facts AS (SELECT DISTINCT * EXCLUDE (filing_id, amend_id), filing_id::BIGINT AS filing_no, amend_id::BIGINT AS amend_no
    FROM ind WHERE org_name <> '' AND filing_start IS NOT NULL),
{org_probe("facts", ORG_ORDER)}, {org_found("org_probe", ORG_ORDER)}
SELECT org, min(filing_start) AS filing_date, min(ls) AS legislative_session, lby_actvty AS activity, f.filing_no AS filing_id,
    f.amend_no AS amendment_id
FROM facts f JOIN org_found o ON f.org_name = o.org_name AND f.filer_id = o.filer_id AND f.type = o.type
GROUP BY org, lby_actvty, f.filing_no, f.amend_no"""

INTENTION_FACTS = f"""lat AS ({latest("intentions", "form_type = 'F501'")}),
    {cleaned_names("lat", "cand_namf", "can_namm", "cand_naml", "NULL::VARCHAR", "*")},
    facts AS (SELECT DISTINCT * FROM (SELECT filer_id AS person_filer, first, middle, last, suffix,
        CASE WHEN {SAID} IN {PARTY_LIST} THEN {SAID} ELSE 'N/A' END AS party, {SAID} AS party_given,
        {label(codes.OFFICE, "office_cd", "offic_dscr")} AS title, coalesce(nullif(agency_nam, ''), 'N/A') AS agency,
        {label(codes.JURISDICTION, "juris_cd", "juris_dscr")} AS jurisdiction,
        CASE WHEN {label(codes.OFFICE, "office_cd", "offic_dscr")} IN ('ASSEMBLY', 'STATE SENATE', 'MEMBER BOARD OF EQUALIZATION')
            THEN nullif({label(codes.DISTRICT, "district_cd", "dist_no")}, 'N/A') END AS district_number,
        {label(codes.ELECTION, "elec_type")} AS election_type, yr_of_elec::INT AS election_year,
        filing_id::BIGINT AS filing_no, amend_id::BIGINT AS amend_no FROM ({dotted("* EXCLUDE (f0, m0, l0, s0)")})))"""
OFFICES = """office AS (SELECT title, agency, jurisdiction, arg_min(district_number, (filing_no, amend_no, coalesce(district_number, '')))
        FILTER (WHERE true) AS arg_district, count(DISTINCT district_number) AS n_named FROM facts GROUP BY ALL),
    office_first AS (SELECT title, agency, jurisdiction, district_number FROM (SELECT *, row_number() OVER (
        PARTITION BY title, agency, jurisdiction ORDER BY filing_no, amend_no, district_number NULLS FIRST) AS nth FROM facts)
        WHERE nth = 1)"""
CANDIDATES = (
    with_views("intentions", "master_person").replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + f", {INTENTION_FACTS}, {OFFICES}, {people_sql('facts', REG_ORDER)}"
)
SQL["registration_rejects"] = with_views("covers").rstrip() + f""", current_covers AS ({newest("covers")})
SELECT filing_id, amend_id, form_type, filer_id, 'bad period' AS reason FROM current_covers
WHERE {parsed("from_date")} IS NULL AND ((form_type = 'F615' AND entity_cd = 'LBY')
    OR (form_type IN ('F625', 'F635') AND entity_cd IN ('FRM', 'LEM', 'LCO')))"""
SQL["contract_rejects"] = with_views("covers").rstrip() + f"""
SELECT DISTINCT filing_id AS act_filing_id, amend_id AS act_amend_id, filer_id AS firm_filer_id, 'bad period' AS reason
FROM ({newest("covers", "form_type = 'F625' AND entity_cd = 'FRM'")}) WHERE {parsed("from_date")} IS NULL"""
SQL["committee_rejects"] = with_views("campaign_covers").rstrip() + f"""
SELECT DISTINCT filer_id, 'bad period' AS reason FROM campaign_covers WHERE {parsed("from_date")} IS NULL"""

SQL["candidate_mart"] = CANDIDATES + """
SELECT w.person_filer, p_first, p_middle, p_last, p_suffix, p_master, w.title, w.agency, w.jurisdiction, o.district_number,
    election_type, election_year, filing_no AS filing_501, amend_no AS amendment_501
FROM (SELECT *, row_number() OVER (PARTITION BY person_filer, anchor_first, title, agency, jurisdiction, election_type,
    election_year ORDER BY filing_no, amend_no) AS nth2 FROM walked) w
JOIN person p ON w.person_filer = p.person_filer AND w.anchor_first = p.anchor_first
JOIN office_first o ON w.title = o.title AND w.agency = o.agency AND w.jurisdiction = o.jurisdiction WHERE nth2 = 1"""
SQL["candidate_parties"] = CANDIDATES + """
SELECT DISTINCT w.person_filer, p_first, party FROM walked w
JOIN person p ON w.person_filer = p.person_filer AND w.anchor_first = p.anchor_first"""
SQL["candidate_offices"] = with_views("intentions").rstrip() + f""", {INTENTION_FACTS}, {OFFICES},
elections AS (SELECT title, agency, jurisdiction, count(DISTINCT (election_type, election_year)) AS n_elections FROM facts GROUP BY ALL)
SELECT title, agency, jurisdiction, CASE WHEN f.district_number IS NOT NULL THEN title END AS chamber, f.district_number AS number,
    n_elections, CASE WHEN n_named > 1 THEN n_named END AS n_districts
FROM office_first f JOIN office USING (title, agency, jurisdiction) JOIN elections USING (title, agency, jurisdiction)"""

COMMITTEE_FACTS = f"""statement AS (SELECT {strip("filer_id")} AS filer_id, {strip("entity_cd")} AS type, {key("filer_naml")} AS org_name,
        upper({strip("city")}) AS city, upper({strip("st")}) AS state, filing_id::BIGINT AS filing_no, amend_id::BIGINT AS amend_no,
        cmtte_type, control_yn, bal_num, bal_name, bal_juris, sup_opp_cd
    FROM (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY amend_id::BIGINT DESC, filing_id, amend_id, form_type, filer_id,
        entity_cd, filer_naml, city, st, cmtte_type, control_yn, bal_num, bal_name, bal_juris NULLS FIRST, sup_opp_cd) AS rn
        FROM statements WHERE form_type = 'F410') WHERE rn = 1),
    facts AS (SELECT * FROM statement WHERE filer_id IN (SELECT filer_id FROM campaign_covers)),
    session_of AS (SELECT * FROM (SELECT DISTINCT filer_id, {session(parsed("from_date"))}::INT AS ls FROM campaign_covers) WHERE ls IS NOT NULL),
    {org_by_filer("facts", ORG_ORDER, "NULL::BIGINT")},
    filed AS (SELECT f.*, o.org FROM facts f JOIN org_of_filer o ON f.org_name = o.org_name AND f.filer_id = o.filer_id AND f.type = o.type)"""
COMMITTEES = with_views("statements", "campaign_covers", "master_org").rstrip() + f", {COMMITTEE_FACTS}"
NAMED_BALLOT = "cmtte_type = 'B' AND bal_num <> '' AND bal_name <> '' AND bal_juris <> '' AND length(bal_num) <= 4"
SQL["committee_subtypes"] = COMMITTEES + f""",
committee AS (SELECT org, filing_no, amend_no FROM (SELECT *, row_number() OVER (PARTITION BY org ORDER BY filing_no, amend_no) AS nth
    FROM filed) WHERE nth = 1),
kinds AS (SELECT DISTINCT org, CASE cmtte_type WHEN 'G' THEN 'general_committee' WHEN 'P' THEN 'independent_committee'
    ELSE 'ballot_committee' END AS subtype FROM filed WHERE cmtte_type IN ('G', 'P') OR ({NAMED_BALLOT}))
SELECT org, subtype, filing_no AS filing_410, amend_no AS amendment_410 FROM committee LEFT JOIN kinds USING (org)"""
SQL["ballot_support"] = COMMITTEES + f""",
measure AS (SELECT org, {strip("bal_num")} AS ballot_number, ls AS legislative_session, {strip("bal_name")} AS name,
    {strip("bal_juris")} AS jurisdiction, upper(sup_opp_cd) = 'S' AS position, filing_no, amend_no
    FROM filed JOIN session_of USING (filer_id) WHERE {NAMED_BALLOT}),
ballot AS (SELECT DISTINCT ON (ballot_number, legislative_session) * FROM measure ORDER BY filing_no, amend_no),
support AS (SELECT DISTINCT ON (org, ballot_number, legislative_session) * FROM measure ORDER BY filing_no, amend_no)
SELECT s.org, s.ballot_number, s.legislative_session, s.position, b.name, b.jurisdiction
FROM support s JOIN ballot b ON s.ballot_number = b.ballot_number AND s.legislative_session = b.legislative_session"""
SQL["controlled_committees"] = (
    with_views("intentions", "master_person", "statements", "campaign_covers", "master_org")
    .replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + f", {INTENTION_FACTS}, {people_sql('facts', REG_ORDER)}, "
    + COMMITTEE_FACTS.replace("facts", "filings")
    + f""",
    held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY committee_id, filing_id ORDER BY amend_id::BIGINT DESC) AS rn
        FROM intentions WHERE form_type = 'F501') WHERE rn = 1),
    {cleaned_names("held", "cand_namf", "can_namm", "cand_naml", "NULL::VARCHAR", "*").replace("c1", "d1").replace("c2", "d2")},
    named AS ({dotted("* EXCLUDE (f0, m0, l0, s0)").replace("c2", "d2")}),
    found AS (SELECT committee_id, filing_id::BIGINT AS filing_no, n.filer_id AS person_filer, coalesce(a.p_first, b.p_first) AS p_first,
            n.first, n.middle, n.last, n.suffix FROM named n LEFT JOIN person a ON a.person_filer = n.filer_id AND a.p_first = n.first
        LEFT JOIN person b ON b.person_filer = n.filer_id AND b.p_first = n.last)
    SELECT org, person_filer, p_first FROM (SELECT c.org, found.*, row_number() OVER (PARTITION BY c.org ORDER BY filing_no, person_filer) AS nth
        FROM (SELECT DISTINCT org, filer_id FROM filed WHERE cmtte_type = 'C' OR control_yn = 'Y') c
        JOIN found ON found.committee_id = c.filer_id WHERE p_first IS NOT NULL) WHERE nth = 1"""
)
SQL["committee_candidates_json"] = SQL["controlled_committees"][: SQL["controlled_committees"].rindex("SELECT org, person_filer, p_first FROM")] + """
SELECT DISTINCT person_filer, p_first, first, middle, last, suffix, NULL::VARCHAR AS title FROM found
WHERE p_first IS NOT NULL AND committee_id IN (SELECT filer_id FROM filed)"""


def counted(**tables: str) -> str:
    """The rows of each table that the first run fills; the second run adds none. `tables` maps a name to its count in SQL."""
    return " UNION ALL ".join(f"SELECT '{t}' AS \"table\", n AS rows, 0::BIGINT AS added FROM (SELECT ({sql})::BIGINT AS n) WHERE n > 0" for t, sql in tables.items())


def rows_of(columns: str, source: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source} WHERE {where})"


FILERS = rows_of("org, filer_id", "org_found", "filer_id <> ''")
NEW_ORGS = rows_of("made", "org_made", "made IS NOT NULL")
PERSON = "person_filer, anchor_first"
SQL["registration_rerun"] = REGISTRATION_MART + counted(
    person="SELECT count(*) FROM person", lobbyist="SELECT count(*) FROM person",
    filer_id=f"({FILERS}) + ({rows_of(PERSON, 'person', chr(39).join(['person_filer <> ', '', '']))})",
    lobbying_firm=rows_of("org", "employed", "form_type = 'F625'"), lobbyist_employer=rows_of("org", "employed", "form_type = 'F635'"),
    permanent_employment=rows_of(f"{PERSON}, org, period_start", "employed", "form_type = 'F625'"),
    direct_employment=rows_of(f"{PERSON}, org, period_start", "employed", "form_type = 'F635'"),
    activity=rows_of("filing_no", "employed", "form_type = 'F635'"),
    employed_lobbying=rows_of(f"{PERSON}, org, period_start, filing_no", "employed", "form_type = 'F635'"),
    org_xref="SELECT count(*) FROM org_found", organizations=NEW_ORGS)


def agreement_counts(name: str, table: str, linked: str, firms: str) -> str:
    decided = SQL[name][: SQL[name].rindex("SELECT ", 0, SQL[name].rindex("FROM (SELECT *, 1 AS copies"))]
    accepted = "SELECT count(*) FROM decided WHERE reason = 'accepted'"
    return decided + counted(**{
        table: accepted, "activity": accepted, linked: accepted, "lobbying_firm": rows_of("org", "org_found", f"type IN ({firms})"),
        "lobbyist_employer": rows_of("org", "org_found", "type = 'LEM'"), "filer_id": FILERS, "org_xref": "SELECT count(*) FROM org_found",
        "organizations": NEW_ORGS})


SQL["contract_rerun"] = agreement_counts("contract_mart", "contract", "contracted_lobbying", "'FRM'")
SQL["subcontract_rerun"] = agreement_counts("subcontract_mart", "subcontract", "subcontracted_lobbying", "'FRM', 'SFRM'")
ON_OWN_ACCOUNT = SQL["individual_mart"][: SQL["individual_mart"].rindex("SELECT org, min(filing_start)")] + """,
own AS (SELECT f.*, o.org FROM facts f JOIN org_found o ON f.org_name = o.org_name AND f.filer_id = o.filer_id AND f.type = o.type)
"""
ACTIVITY = rows_of("org, filing_no, amend_no, lby_actvty", "own")
SQL["individual_rerun"] = ON_OWN_ACCOUNT + counted(
    activity=ACTIVITY, individual_lobbying=ACTIVITY, lobbying_firm=rows_of("org", "own", "type = 'FRM'"),
    lobbyist_employer=rows_of("org", "own", "type IN ('LEM', 'LCO')"), filer_id=FILERS, org_xref="SELECT count(*) FROM org_found",
    organizations=NEW_ORGS)
SEAT = "title, agency, jurisdiction, district_number"
SQL["candidate_rerun"] = CANDIDATES + counted(
    person="SELECT count(*) FROM person", candidate=rows_of(f"{PERSON}, party", "walked"), filer_id=rows_of(PERSON, "person", "person_filer <> ''"),
    district=rows_of("title, district_number", "facts", "district_number IS NOT NULL"), office=rows_of(SEAT, "facts"),
    election=rows_of(f"{SEAT}, election_type, election_year", "facts", "election_year IS NOT NULL"),
    running=rows_of(f"{PERSON}, {SEAT}, election_type, election_year", "walked", "election_year IS NOT NULL"))
SQL["committee_rerun"] = COMMITTEES + f""",
measure AS (SELECT org, {strip("bal_num")} AS ballot_number, ls FROM filed JOIN session_of USING (filer_id) WHERE {NAMED_BALLOT})
""" + counted(
    committee=rows_of("org", "filed"), general_committee=rows_of("org", "filed", "cmtte_type = 'G'"),
    independent_committee=rows_of("org", "filed", "cmtte_type = 'P'"), ballot=rows_of("ballot_number, ls", "measure"),
    ballot_committee=rows_of("org", "measure"), ballot_support=rows_of("org, ballot_number, ls", "measure"),
    filer_id=rows_of("org, filer_id", "org_of_filer", "filer_id <> ''"), org_xref="SELECT count(*) FROM org_of_filer", organizations=NEW_ORGS)


def outcomes(job: str, source: str, view: str, where: str, refused: dict[str, str], by: str = "f", one: str = "") -> str:
    """What becomes of a view's rows: `refused` maps a reason to its condition. `one` orders tied rows of which one counts."""
    cases = " ".join(f"WHEN coalesce({condition}, false) THEN '{reason}'" for reason, condition in refused.items())
    older = f"row_number() OVER (PARTITION BY bad, {by} ORDER BY a DESC{', ' + one if one else ''}) > 1" if one else f"a < max(a) OVER (PARTITION BY bad, {by})"
    return f"""SELECT '{job}' AS job, '{source}' AS source, outcome, count(*) AS n FROM (SELECT CASE WHEN bad THEN 'bad filing id' WHEN older THEN 'superseded'
        {cases} ELSE 'accepted' END AS outcome FROM (SELECT *, {older} AS older FROM (SELECT *, TRY_CAST(filing_id AS BIGINT) AS f,
            TRY_CAST(amend_id AS BIGINT) AS a, TRY_CAST(filing_id AS BIGINT) IS NULL OR TRY_CAST(amend_id AS BIGINT) IS NULL AS bad
            FROM {view} WHERE {where}))) GROUP BY outcome"""


LOBBYIST = "(form_type = 'F615' AND entity_cd = 'LBY')"
FIRM_OR_EMPLOYER = "(form_type IN ('F625', 'F635') AND entity_cd IN ('FRM', 'LEM', 'LCO'))"
BAD_PERIOD = {"bad period": f"{parsed('from_date')} IS NULL"}
SQL["registration_ledger"] = with_damaged("covers", "registrations") + outcomes("registrations", "lobby_disclosure", "covers", "true", {
    "other form": f"NOT ({LOBBYIST} OR {FIRM_OR_EMPLOYER})", **BAD_PERIOD,
    "no organisation": f"trim(CASE WHEN {LOBBYIST} THEN firm_name ELSE filer_naml END) = ''",
    "no name": f"{LOBBYIST} AND trim(filer_naml) = '' AND trim(filer_namf) = ''",
}) + " UNION ALL " + outcomes("registrations", "registration", "registrations", "form_type = 'F604' AND entity_cd = 'LBY'", {})
for job in ("contracts", "subcontracts"):
    SQL[f"{job[:-1]}_ledger"] = with_damaged(*ENGAGEMENT_VIEWS) + " UNION ALL ".join([
        outcomes(job, "lobby_disclosure", "covers", "form_type = 'F625' AND entity_cd = 'FRM'", {**BAD_PERIOD, "no firm": "trim(filer_naml) = ''"}),
        outcomes(job, "registration", "registrations", "form_type = 'F601' AND entity_cd = 'FRM'",
                 {"bad session": "TRY_CAST(ls_beg_yr AS INT) IS NULL", "no firm": "trim(filer_naml) = ''"}),
        outcomes(job, "payment_line", "payments", "true", {"no employer": "trim(emplr_naml) = ''"}),
        outcomes(job, "employer_line", "employers", "true", {"no employer": "trim(cli_naml) = ''"}),
        outcomes(job, "subcontract_line", "subcontract_lines", "true", {"no employer": "trim(subj_naml) = ''"}),
    ])
SQL["individual_ledger"] = with_damaged("covers") + outcomes("individuals", "lobby_disclosure", "covers", "form_type = 'F645'", {
    "no filing date": f"{parsed('from_date')} IS NULL", "no name": "coalesce(trim(filer_namf || filer_naml), '') = ''"})
SQL["candidate_ledger"] = with_damaged("intentions") + outcomes("candidates", "candidate_intention", "intentions", "form_type = 'F501'", {
    "no name": "trim(cand_naml) = '' AND trim(cand_namf) = ''", "no election year": "TRY_CAST(nullif(yr_of_elec, '') AS INT) IS NULL"})
SQL["committee_ledger"] = with_damaged("statements", "campaign_covers") + outcomes("committees", "committee_statement", "statements", "form_type = 'F410'", {
    "no campaign cover": f"{strip('filer_id')} NOT IN (SELECT filer_id FROM campaign_covers)",
}, one="filing_id, amend_id, form_type, filer_id, entity_cd, filer_naml, city, st, cmtte_type, control_yn, bal_num, bal_name, bal_juris NULLS FIRST, sup_opp_cd") + f"""
UNION ALL SELECT 'committees', 'campaign_cover', CASE WHEN {parsed("from_date")} IS NULL THEN 'bad period' ELSE 'accepted' END, count(*) FROM campaign_covers GROUP BY 3"""

# the declared contracts hold in every table that the jobs fill; its rows are those that a job adds
OFFICE = "title, agency, jurisdiction"
CANDIDATE_TABLES = {
    "person": "SELECT count(*) FROM person", "candidate": rows_of(f"{PERSON}, party", "walked"), "filer_id": rows_of(PERSON, "person", "person_filer <> ''"),
    "district": rows_of("title, district_number", "facts", "district_number IS NOT NULL"), "office": rows_of(OFFICE, "facts"),
    "election": rows_of(f"{OFFICE}, election_type, election_year", "facts", "election_year IS NOT NULL"),
    "running": rows_of(f"{PERSON}, {OFFICE}, election_type, election_year", "walked", "election_year IS NOT NULL"),
}
FILLED = {"candidates": CANDIDATES + counted(**CANDIDATE_TABLES)} | {
    f"{job}s": SQL[f"{job}_rerun"] for job in ("registration", "contract", "subcontract", "individual", "committee")}
SQL["mart_violations"] = " UNION ALL ".join(
    f"""SELECT '{job}.' || "table" AS "table", rows, 0::BIGINT AS violations FROM ({sql}) WHERE "table" NOT IN ('org_xref', 'organizations')"""
    for job, sql in FILLED.items())
# faults in every row: of candidates each twice, of districts, and of elections whose offices are gone
SQL["planted_violations"] = CANDIDATES + " UNION ALL ".join(
    f"""SELECT '{table}' AS "table", '{kind}' AS "check", '{detail}' AS detail, n AS violations
    FROM (SELECT ({times} * ({CANDIDATE_TABLES[table]}))::BIGINT AS n) WHERE n > 0"""
    for table, kind, detail, times in (
        ("candidate", "primary", "person_id,party", 2), ("candidate", "domain", "party", 2), ("district", "required", "number", 1),
        ("election", "parent", "office_id->office", 1)))
