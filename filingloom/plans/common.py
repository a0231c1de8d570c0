"""What the jobs share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.operators.identity import merge_identities
from filingloom.operators.mart import first_wins, surrogate_key, without
from filingloom.operators.resolve import ORG_KEY, conflicts, fill_missing, person_names, resolve_people
from filingloom.sources.tables import conform

Frames = dict[str, DataFrame]

NAME_PARTS = ["first", "middle", "last"]


def number(c: str) -> Column:
    """A filing or amendment id from text; null when it is not a number."""
    return F.col(c).try_cast("bigint")


def loaded(mart: Frames, table: str) -> DataFrame | None:
    """A mart table's rows of earlier runs, if there is such a snapshot."""
    return mart.get(table)


def only_new(rows: DataFrame, mart: Frames, table: str, key: list[str]) -> DataFrame:
    """The rows as the mart table declares them, less those whose key is loaded already."""
    rows = conform(rows, table)
    return without(rows, mart[table], key) if table in mart else rows


def stored_people(mart: Frames, candidates_only: bool = False) -> DataFrame | None:
    """People of the mart with their filer ids: filer_id, _id and name parts."""
    if "person" not in mart or "filer_id" not in mart:
        return None
    people = mart["person"]
    if candidates_only:
        if "candidate" not in mart:
            return None
        people = people.join(mart["candidate"].select(F.col("person_id").alias("_id")).distinct(), "_id", "left_semi")
    filers = mart["filer_id"].filter("person_id IS NOT NULL AND filer_id <> ''")
    return filers.select(F.col("person_id").alias("_id"), "filer_id").distinct().join(people, "_id")


def identify(
    rows: DataFrame, kind: str, order: list[str], stored: DataFrame | None
) -> DataFrame:
    """Add person_id to rows with person_filer, first, middle, last; a stored person keeps its id."""
    existing = None
    if stored is not None:
        known = stored.groupBy(F.col("filer_id").alias("person_filer"), "first").agg(F.min("_id").alias("_known"))
        existing = known.select("person_filer", "first")
    merged = merge_identities(rows, "person_filer", "first", "last", order, existing)
    made = surrogate_key(F.col("person_filer"), F.col("anchor_first"), F.col("anchor_last"), kind=kind)
    if stored is None:
        return merged.withColumn("person_id", made)
    known = known.withColumnRenamed("first", "anchor_first")
    joined = merged.join(known, ["person_filer", "anchor_first"], "left")
    return joined.withColumn("person_id", F.coalesce("_known", made)).select(*merged.columns, "person_id")


def load_people(
    rows: DataFrame, master: DataFrame, order: list[str], mart: Frames
) -> Frames:
    """New person rows with their master match, changed stored rows, and name conflicts.

    The first row of a person is what is stored and matched; later rows only fill what it left
    null. `rows` has person_id, person_filer, the name parts, suffix and title.
    """
    names = [*NAME_PARTS, "suffix", "title"]
    firsts = first_wins(rows.select("person_id", "person_filer", *names, *order), ["person_id"], order)
    incoming = rows.select("person_id", *NAME_PARTS, *order)
    stored = firsts.select(F.col("person_id"), *names)
    if "person" in mart:
        known = mart["person"].withColumnRenamed("_id", "person_id")
        before = known.join(firsts.select("person_id"), "person_id", "left_semi")
        fresh = without(stored, known, ["person_id"])
        updated = fill_missing(before, incoming, ["person_id"], NAME_PARTS, order)
        changed = without(updated, before, before.columns)
        compared = before.select("person_id", *NAME_PARTS).unionByName(fresh.select("person_id", *NAME_PARTS))
    else:
        fresh, changed, compared = stored, None, stored
    matched = resolve_people(fresh, person_names(master))
    filled = fill_missing(matched, incoming, ["person_id"], NAME_PARTS, order)
    out = {
        "person": conform(filled.withColumnRenamed("person_id", "_id"), "person"),
        "person_matches": matched.select("person_id", "match_rule", "n_candidates"),
        "conflicts": conflicts(compared, rows, ["person_id"], NAME_PARTS),
    }
    if changed is not None:
        out["person_updates"] = conform(changed.withColumnRenamed("person_id", "_id"), "person")
    return out


def xref_rows(resolved: DataFrame, mart: Frames) -> DataFrame:
    """Organisations resolved in this run that the reference table does not hold yet."""
    rows = resolved.select(*ORG_KEY, "organization_id")
    return without(rows, mart["org_xref"], ORG_KEY) if "org_xref" in mart else rows


def org_filers(resolved: DataFrame) -> DataFrame:
    return resolved.select("organization_id", "filer_id")


def person_filers(rows: DataFrame) -> DataFrame:
    return rows.select("person_id", F.col("person_filer").alias("filer_id"))
