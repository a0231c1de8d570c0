"""Mart building: keys, first-wins loading, lookups, bridges, routing and links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingloom.sources.snapshots import stage


MAX_CODES = 1_000


def surrogate_key(*natural_key: Column, kind: str = "") -> Column:
    """A key computed from the natural key alone, so any run on any cluster gives the same one.

    The sign bit is always set: a made key is negative and never meets an id of master data.
    Two natural keys with the same hash show up in `key_collisions` and in the primary key check.
    """
    # nulls and values are told apart: xxhash64 alone skips nulls
    parts = [F.lit(kind)]
    for c in natural_key:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts).bitwiseOR(F.lit(-(2**63)))


def key_collisions(df: DataFrame, key: str, natural_key: list[str]) -> DataFrame:
    """Keys that stand for more than one natural key."""
    return df.select(key, *natural_key).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def without(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` that have no match in `other`; nulls match nulls."""
    keys = other.select(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(on)]).distinct()
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(on)]
    return df.join(keys, same, "left_anti")


def first_wins(
    df: DataFrame, key: list[str], order: list[str], existing: DataFrame | None = None
) -> DataFrame:
    """One row per key, the first by `order` and then by all columns; keys already loaded are left out.

    The row-number filter runs before the shuffle too, so a repeated key sends one row per task.
    """
    columns = df.columns
    rest = list(dict.fromkeys([*order, *columns]))
    window = Window.partitionBy(*key).orderBy(*rest)
    firsts = df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").select(*columns)
    return firsts if existing is None else without(firsts, existing, key)


def insert_or_reject(
    df: DataFrame,
    rules: dict[str, Column],
    key: list[str],
    order: list[str],
    existing: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split rows into accepted ones and rejected ones with a reason.

    `rules` maps a reason to the condition under which a row is refused; the first that holds is
    the reason, and a null in the key is "no key". Of the rest the first row per key is accepted, and later ones are refused as
    "duplicate" or, when the key is already loaded, as "exists". Identical rows are counted
    and written before anything is shuffled by key; `copies` in the rejected frame is how many rows one
    line stands for, so accepted rows + the sum of copies = input rows.
    """
    columns = df.columns
    reason = F.lit(None).cast("string")
    no_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    for name, refused in reversed([*rules.items(), ("no key", no_key)]):
        reason = F.when(F.coalesce(refused, F.lit(False)), F.lit(name)).otherwise(reason)
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("reason", reason)
    # both results, and the winners they are told by, come from it
    counted = stage(counted, "counted-rows")
    if existing is not None:
        loaded = existing.select(*key).distinct().withColumn("_loaded", F.lit(True))
        counted = counted.join(loaded, key, "left")
        counted = counted.withColumn(
            "reason", F.coalesce("reason", F.when(F.col("_loaded"), F.lit("exists")))
        ).drop("_loaded")
    rest = list(dict.fromkeys([*order, *columns]))
    position = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in rest])
    winners = counted.filter("reason IS NULL").groupBy(*key).agg(F.min(position).alias("_winner"))
    ranked = counted.join(winners, key, "left").withColumn("_wins", F.col("reason").isNull() & position.eqNullSafe(F.col("_winner")))
    accepted = ranked.filter("_wins").select(*columns)
    rejected = (
        ranked.withColumn("copies", F.col("copies") - F.col("_wins").cast("int"))
        .filter("copies > 0")
        .select(*columns, F.coalesce("reason", F.lit("duplicate")).alias("reason"), "copies")
    )
    return accepted, rejected


def lookup_or_create(
    df: DataFrame, natural_key: list[str], existing: DataFrame | None = None, id_col: str = "_id", kind: str = ""
) -> DataFrame:
    """Distinct natural keys with their id: the stored one where the key exists, else a new one.

    `is_new` tells the two apart.
    """
    made = surrogate_key(*[F.col(c) for c in natural_key], kind=kind)
    keys = df.select(*natural_key).distinct()
    if existing is None:
        return keys.withColumn(id_col, made).withColumn("is_new", F.lit(True))
    stored = existing.groupBy(*natural_key).agg(F.min(id_col).alias("_stored"))
    both = keys.alias("k").join(
        stored.alias("s"), [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in natural_key], "left"
    ).select("k.*", "_stored")
    return both.select(
        *natural_key, F.coalesce("_stored", made).alias(id_col), F.col("_stored").isNull().alias("is_new")
    )


def filer_bridge(people: DataFrame | None, orgs: DataFrame | None) -> DataFrame:
    """filer_id rows for people (person_id, filer_id) and organisations (organization_id, filer_id)."""
    blank = F.lit(None).cast("bigint")
    parts = []
    if orgs is not None:
        parts.append(orgs.select("organization_id", blank.alias("person_id"), "filer_id"))
    if people is not None:
        parts.append(people.select(blank.alias("organization_id"), "person_id", "filer_id"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.filter(F.col("filer_id") != "").distinct()


def route(df: DataFrame, rules: dict[str, Column], columns: list[str]) -> dict[str, DataFrame]:
    """Distinct `columns` of the rows each subtype's condition selects."""
    return {name: df.filter(condition).select(*columns).distinct() for name, condition in rules.items()}


def link(facts: DataFrame, other: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """Distinct pairs of ids that connect facts with the rows they belong to."""
    mine = facts.select(*dict.fromkeys([*on, *[k for k in keys if k in facts.columns]])).distinct()
    theirs = other.select(*dict.fromkeys([*on, *[k for k in keys if k in other.columns]])).distinct()
    return mine.join(theirs, on).select(*keys).distinct()


def add_parties(filed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """(person_id, party) pairs not yet stored, one row per party a person files under."""
    pairs = filed.select("person_id", "party").distinct()
    return pairs if existing is None else without(pairs, existing, ["person_id", "party"])


def parties_of(candidates: DataFrame) -> DataFrame:
    """Each person's parties; the array is bounded by the party domain."""
    return candidates.groupBy("person_id").agg(F.sort_array(F.collect_set("party")).alias("parties"))


def decode(
    df: DataFrame, code_col: str, codes: dict[str, str], out: str, text_col: str | None = None, default: str = "N/A"
) -> DataFrame:
    """Add `out`: the text where given, else the code's label, else the default.

    Codes are a fixed list; one of up to MAX_CODES entries is broadcast.
    """
    if len(codes) > MAX_CODES:
        raise ValueError(f"a code table has at most {MAX_CODES} entries")
    labels = F.broadcast(df.sparkSession.createDataFrame(list(codes.items()), "_code string, _label string"))
    text = F.nullif(F.col(text_col), F.lit("")) if text_col else F.lit(None).cast("string")
    return (
        df.join(labels, F.col(code_col) == F.col("_code"), "left")
        .withColumn(out, F.coalesce(text, F.col("_label"), F.lit(default)))
        .drop("_code", "_label")
    )
