"""Entity resolution: organisations and people against master data, each with its match rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from filingloom.functions.text import blank_to_null, middle_initial, name_key
from filingloom.operators.mart import first_wins, surrogate_key
from filingloom.sources.snapshots import stage

# Names that stand for "no name given". They say nothing about identity, so such
# an organisation is told apart by its filer id.
PLACEHOLDER_NAMES = ("X", "XX", "XXX", "NONE", "N/A", "NA", "UNKNOWN", "TBD", ".", "-")
MIN_NAME_LENGTH = 1

# Fixed value: the master source preferred when several people share a name.
PREFERRED_SOURCE = "TT_Lobbyist"

ORG_KEY = ["org_name", "filer_id", "type"]


def _exactly_one(lowest: Column, highest: Column) -> Column:
    """True when a group holds exactly one distinct id; null-safe, so an empty group is false."""
    return F.coalesce(lowest == highest, F.lit(False))


def org_probes(df: DataFrame, order: list[str]) -> DataFrame:
    """One probe per (name, filer, type): the place of the first row counts, as a later row reuses it."""
    probes = df.select(
        name_key(F.col("org_name")).alias("org_name"),
        F.coalesce(F.col("filer_id"), F.lit("")).alias("filer_id"),
        F.col("type"),
        F.col("city"),
        F.col("state"),
        *order,
    )
    return first_wins(probes, ORG_KEY, order)


def resolve_orgs(
    probes: DataFrame,
    master: DataFrame,
    order: list[str],
    xref: DataFrame | None = None,
    bridge: DataFrame | None = None,
    by_filer: bool = False,
    placeholders: tuple[str, ...] = PLACEHOLDER_NAMES,
    min_name_length: int = MIN_NAME_LENGTH,
) -> tuple[DataFrame, DataFrame]:
    """Resolve organisations by a cascade; returns (resolved, new_orgs).

    `probes` come from `org_probes`; `master` has oid, name, city, state. The rules, in order:
    "cache" (in `xref` already; the master data is then not asked, so n_candidates is 0), "filer" (the filer id has an organisation in `bridge`),
    "placeholder" (no usable name: told apart by filer id), "name" (one organisation of that name),
    "name_place" (several, one of them in the same city or state), "new_ambiguous" (several and
    no single one fits: new per name and place), "new" (none: new per name). With `by_filer` one
    organisation is kept per filer id, found through that filer's first probe.

    resolved: org_name, filer_id, type, organization_id, match_rule, n_candidates.
    new_orgs: organization_id, name, city, state.
    """
    m = master.select(
        "oid", name_key(F.col("name")).alias("org_name"), F.upper("city").alias("city"), F.upper("state").alias("state")
    )
    by_name = m.groupBy("org_name").agg(F.count_distinct("oid").alias("_n"), F.min("oid").alias("_name_id"))
    by_city = m.groupBy("org_name", "city").agg(F.min("oid").alias("_c_lo"), F.max("oid").alias("_c_hi"))
    by_state = m.groupBy("org_name", "state").agg(F.min("oid").alias("_s_lo"), F.max("oid").alias("_s_hi"))

    lead = probes.withColumn("city", F.upper("city")).withColumn("state", F.upper("state"))
    if by_filer:
        lead = first_wins(lead.filter("filer_id <> ''"), ["filer_id"], order).unionByName(
            lead.filter("filer_id = ''")
        )
    if xref is not None:  # what is known leaves before any lookup in the master data
        cached = (
            xref.withColumn("filer_id", F.coalesce("filer_id", F.lit("")))
            .groupBy(*ORG_KEY)
            .agg(F.min("organization_id").alias("_cache_id"))
        )
        seen = Observation()
        lead = stage(lead.join(cached, ORG_KEY, "left").observe(seen, F.count_if(F.col("_cache_id").isNull()).alias("unknown")), "asked-orgs")
        known_before, lead = lead.filter("_cache_id IS NOT NULL"), lead.filter("_cache_id IS NULL").drop("_cache_id")
        if not seen.get["unknown"]:  # nobody asks, so the master data need not be read
            by_name, by_city, by_state = (df.sparkSession.createDataFrame([], df.schema) for df in (by_name, by_city, by_state))
    # "in the same city or state" as two equi lookups: a name's probes never meet all its organisations
    looked = lead.join(by_name, "org_name", "left")
    looked = looked.join(by_city, ["org_name", "city"], "left")
    looked = looked.join(by_state, ["org_name", "state"], "left")
    if bridge is not None:
        known = (
            bridge.filter("organization_id IS NOT NULL AND filer_id <> ''")
            .groupBy("filer_id")
            .agg(F.min("organization_id").alias("_filer_id"))
        )
        # blank filer ids match nothing and need not meet in one task
        blank = looked.filter("filer_id = ''").withColumn("_filer_id", F.lit(None).cast("bigint"))
        looked = looked.filter("filer_id <> ''").join(known, "filer_id", "left").unionByName(blank)
    else:
        looked = looked.withColumn("_filer_id", F.lit(None).cast("bigint"))

    no_name = (F.length("org_name") < min_name_length) | F.col("org_name").isin(*placeholders)
    looked = looked.withColumns({
        "n_candidates": F.coalesce("_n", F.lit(0)),
        "_place_id": F.least("_c_lo", "_s_lo"),
        "_one_place": _exactly_one(F.least("_c_lo", "_s_lo"), F.greatest("_c_hi", "_s_hi")),
    })
    n, rule = F.col("n_candidates"), F.col("match_rule")
    looked = looked.withColumn(
        "match_rule",
        F.when(F.col("_filer_id").isNotNull(), "filer")
        .when(no_name, "placeholder")
        .when(n == 1, "name")
        .when((n > 1) & F.col("_one_place"), "name_place")
        .when(n > 1, "new_ambiguous")
        .otherwise("new"),
    )
    by_place = surrogate_key(F.col("org_name"), F.col("city"), F.col("state"), kind="org-place")
    decided = looked.select(
        *ORG_KEY,
        "city",
        "state",
        *order,
        F.when(rule == "filer", F.col("_filer_id"))
        .when(rule == "name", F.col("_name_id"))
        .when(rule == "name_place", F.col("_place_id"))
        .when(rule == "new", surrogate_key(F.col("org_name"), kind="org-name"))
        .when((rule == "placeholder") & (F.col("filer_id") != ""), surrogate_key(F.col("filer_id"), kind="org-filer"))
        .otherwise(by_place)
        .alias("organization_id"),
        "match_rule",
        "n_candidates",
    )
    if xref is not None:
        again = [*ORG_KEY, "city", "state", *order]
        cache = known_before.select(*again, F.col("_cache_id").alias("organization_id"), F.lit("cache").alias("match_rule"), F.lit(0).cast("bigint").alias("n_candidates"))
        decided = decided.withColumn("n_candidates", F.col("n_candidates").cast("bigint")).unionByName(cache)
    decided = stage(decided, "decided-orgs")  # both results come from it
    new_orgs = first_wins(
        decided.filter(F.col("match_rule").isin("placeholder", "new", "new_ambiguous")).select(
            "organization_id", F.col("org_name").alias("name"), "city", "state", *order
        ),
        ["organization_id"],
        order,
    ).select("organization_id", "name", "city", "state")
    outcome = ["organization_id", "match_rule", "n_candidates"]
    if not by_filer:
        return decided.select(*ORG_KEY, *outcome), new_orgs
    of_filer = decided.filter("filer_id <> ''").select("filer_id", *outcome)
    named = probes.filter("filer_id <> ''").select(*ORG_KEY).join(of_filer, "filer_id")
    unnamed = decided.filter("filer_id = ''").select(*ORG_KEY, *outcome)
    return named.select(*ORG_KEY, *outcome).unionByName(unnamed), new_orgs


def resolve_people(
    probes: DataFrame, master: DataFrame, preferred_source: str = PREFERRED_SOURCE
) -> DataFrame:
    """Add master_pid, match_rule and n_candidates to probes that have first, middle and last.

    `master` has pid, first, middle, last, source. Rules, in order: "middle" (one person whose
    middle name starts with the given one, or one without a middle name when none is given),
    "name" (none of those, but one person of that first and last name), "preferred" (several, one
    of them from the preferred source); otherwise "ambiguous_middle", "ambiguous" or "none",
    all without a master id.
    """
    by_middle = master.groupBy("first", "last", "middle").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("pid").alias("lo"),
        F.max("pid").alias("hi"),
        F.min(F.when(F.col("source") == preferred_source, F.col("pid"))).alias("p_lo"),
        F.max(F.when(F.col("source") == preferred_source, F.col("pid"))).alias("p_hi"),
    )
    by_name = by_middle.groupBy("first", "last").agg(
        F.sum("n").alias("_n"),
        F.min("lo").alias("_lo"),
        F.min("p_lo").alias("_p_lo"),
        F.max("p_hi").alias("_p_hi"),
    )
    # A prefix match as an equi join: every prefix of every distinct middle name, and one entry
    # for people without one.
    no_middle = F.coalesce(F.col("middle") == "", F.lit(True))
    prefixes = F.transform(F.sequence(F.lit(0), F.length("middle")), lambda i: F.substring("middle", F.lit(1), i))
    with_prefix = by_middle.filter("middle IS NOT NULL").select(
        "first", "last", F.lit(True).alias("_given"), F.explode(prefixes).alias("_prefix"), "lo", "hi"
    )
    without_prefix = by_middle.filter(no_middle).select(
        "first", "last", F.lit(False).alias("_given"), F.lit("").alias("_prefix"), "lo", "hi"
    )
    by_prefix = (
        with_prefix.unionByName(without_prefix)
        .groupBy("first", "last", "_given", "_prefix")
        .agg(F.min("lo").alias("_m_lo"), F.max("hi").alias("_m_hi"))
    )
    initial = middle_initial(F.col("middle"))
    asked = probes.withColumn("_given", initial.isNotNull()).withColumn("_prefix", F.coalesce(initial, F.lit("")))
    looked = asked.join(by_prefix, ["first", "last", "_given", "_prefix"], "left").join(by_name, ["first", "last"], "left")
    n = F.coalesce("_n", F.lit(0))
    rule = (
        F.when(F.col("_m_lo") == F.col("_m_hi"), "middle")
        .when(F.col("_m_lo").isNotNull(), "ambiguous_middle")
        .when(n == 1, "name")
        .when(n == 0, "none")
        .when(_exactly_one(F.col("_p_lo"), F.col("_p_hi")), "preferred")
        .otherwise("ambiguous")
    )
    return looked.select(
        *probes.columns,
        F.when(rule == "middle", F.col("_m_lo"))
        .when(rule == "name", F.col("_lo"))
        .when(rule == "preferred", F.col("_p_lo"))
        .alias("master_pid"),
        rule.alias("match_rule"),
        n.alias("n_candidates"),
    )


def match_summary(resolved: DataFrame) -> DataFrame:
    """How many probes each match rule decided; the unmatched report."""
    return resolved.groupBy("match_rule").agg(F.count(F.lit(1)).alias("n"))


def fill_missing(stored: DataFrame, incoming: DataFrame, key: list[str], cols: list[str], order: list[str]) -> DataFrame:
    """Stored rows with null columns filled by the first incoming value in order; values never change."""
    position = F.struct(*order)
    found = incoming.groupBy(*key).agg(
        *[
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(position, F.col(c)))).alias(f"_in_{c}")
            for c in cols
        ]
    )
    joined = stored.join(found, key, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in cols}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in stored.columns])


def conflicts(
    stored: DataFrame, incoming: DataFrame, key: list[str], cols: list[str]
) -> DataFrame:
    """Incoming values that differ from the stored ones: key, field, stored, incoming."""
    seen = incoming.select(*key, *[F.col(c).alias(f"_in_{c}") for c in cols]).distinct()
    both = seen.join(stored.select(*key, *cols), key)
    fields = F.array(
        *[
            F.struct(
                F.lit(c).alias("field"), F.col(c).cast("string").alias("stored"), F.col(f"_in_{c}").cast("string").alias("incoming")
            )
            for c in cols
        ]
    )
    return (
        both.select(*key, F.explode(fields).alias("f"))
        .select(*key, "f.*")
        .filter(~F.col("stored").eqNullSafe(F.col("incoming")))
        .distinct()
    )


def person_names(df: DataFrame) -> DataFrame:
    """Master people in the form names are compared in."""
    return df.select(
        "pid",
        *[blank_to_null(name_key(F.col(c))).alias(c) for c in ("first", "middle", "last")],
        "source",
    )
