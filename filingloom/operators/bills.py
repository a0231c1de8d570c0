"""Bill mentions in activity text, such as "AB 12, 40;SB 7"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingloom.functions.text import strip


def bill_mentions(activity: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """One row per mentioned bill: the `keep` columns, bill_type and number.

    Groups are separated by semicolons; the word before the first space of a group is the bill
    type and the rest a comma list of numbers. A group without a space, such as NONE, names none.
    """
    groups = activity.select(*keep, F.explode(F.split(text_col, ";")).alias("_group"))
    trimmed = groups.withColumn("_group", strip(F.col("_group"))).filter(F.instr("_group", " ") > 0)
    cut = F.instr("_group", " ")
    return trimmed.select(
        *keep,
        F.col("_group").substr(F.lit(1), cut - 1).alias("bill_type"),
        F.explode(F.split(F.col("_group").substr(cut + 1, F.length("_group")), ",")).alias("number"),
    ).withColumn("number", strip(F.col("number")))


def link_bills(
    mentions: DataFrame, bills: DataFrame, session_col: str, state: str = "CA"
) -> DataFrame:
    """Mentions with the bill id of that type, number and session, null where there is none or not just one."""
    known = (
        bills.filter(F.col("state") == state)
        .groupBy(F.col("type").alias("bill_type"), "number", F.col("session_year").alias(session_col))
        .agg(F.min("bid").alias("_lo"), F.max("bid").alias("_hi"))
    )
    joined = mentions.join(known, ["bill_type", "number", session_col], "left")
    return joined.withColumn("bid", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))).drop("_lo", "_hi")


def bill_coverage(linked: DataFrame) -> DataFrame:
    """Per bill type: how many mentions there are and how many name a known bill."""
    return linked.groupBy("bill_type").agg(
        F.count(F.lit(1)).alias("mentions"), F.count("bid").alias("matched")
    )
