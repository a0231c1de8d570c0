"""What becomes of a job's input rows: how many count, how many are refused, and for which reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filingloom.sources.snapshots import stage, unstage

ACCEPTED, SUPERSEDED, BAD_ID = "accepted", "superseded", "bad filing id"
SCHEMA = "job string, source string, outcome string, n bigint"


def first_reason(rules: dict[str, Column]) -> Column:
    """The first reason whose condition holds, null if none does; a null condition does not hold."""
    reason = F.lit(None).cast("string")
    for name, refused in reversed(rules.items()):
        reason = F.when(F.coalesce(refused, F.lit(False)), F.lit(name)).otherwise(reason)
    return reason


class Ledger:
    """The account of one job. Rows are counted while they are written, so it costs no further pass.

    A source passes twice. `usable` takes its rows as they are and refuses those whose ids are no numbers, before
    anything is ranked by them. `settle` takes the rows that the job goes on with, the latest amendments, and refuses
    those it can't use; what it does not see again was superseded. So for each source the outcomes add up to its rows.
    The counts belong to the last stage of a write, whose tasks count once however often they run. The usable rows of a source
    are needed until it is settled, and their table is deleted then; what was refused of them has a table of its own.
    """

    def __init__(self, job: str) -> None:
        self.job = job
        self.counts: dict[tuple[str, str], int] = {}
        self.open: dict[str, int] = {}  # usable rows that are not settled yet, by source
        self.unsettled: dict[str, DataFrame] = {}  # the tables that hold them
        self.refused: list[DataFrame] = []

    def _split(
        self, rows: DataFrame, source: str, rules: dict[str, Column], silent: tuple[str, ...], passing: bool = False,
    ) -> tuple[DataFrame, DataFrame, int]:
        seen = Observation()
        kinds = list(rules)
        marked = rows.withColumn("reason", first_reason(rules)).observe(
            seen, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("reason") == k).alias(f"n{i}") for i, k in enumerate(kinds)])
        if silent:
            marked = marked.filter(F.col("reason").isNull() | ~F.col("reason").isin(*silent))
        written = stage(marked, f"{self.job}-{source}")
        got = seen.get
        for i, k in enumerate(kinds):
            if got[f"n{i}"]:
                self.counts[source, k] = self.counts.get((source, k), 0) + got[f"n{i}"]
        # without a refused row nothing needs to be read for them
        any_refused = any(got[f"n{i}"] for i, k in enumerate(kinds) if k not in silent)
        refused = written.filter("reason IS NOT NULL" if any_refused else F.lit(False))
        if passing:
            self.unsettled[source] = written
            refused = stage(refused, f"{self.job}-{source}-refused") if any_refused else refused
        ids = [F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("filing_id", "amend_id")]
        self.refused.append(refused.select(F.lit(source).alias("source"), *ids, "reason"))
        return written.filter("reason IS NULL").drop("reason"), refused, got["n"]

    def usable(self, rows: DataFrame, source: str, filing: str = "filing_id", amendment: str = "amend_id") -> tuple[DataFrame, DataFrame]:
        """The rows whose filing and amendment are numbers, and the others."""
        bad = F.col(filing).try_cast("bigint").isNull() | F.col(amendment).try_cast("bigint").isNull()
        good, refused, n = self._split(rows, source, {BAD_ID: bad}, (), passing=True)
        self.open[source] = n - self.counts.get((source, BAD_ID), 0)
        return good, refused

    def settle(self, rows: DataFrame, source: str, rules: dict[str, Column] | None = None, silent: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
        """The rows that no rule refuses, and the refused ones with their reason; those refused for a silent reason are only counted.

        The source's usable rows can't be read any more after this.
        """
        rules = rules or {}
        before = sum(self.counts.get((source, k), 0) for k in rules)
        good, refused, n = self._split(rows, source, rules, silent)
        self.counts[source, ACCEPTED] = n - (sum(self.counts.get((source, k), 0) for k in rules) - before)
        if source in self.unsettled:
            unstage(self.unsettled.pop(source))
        if (gone := self.open.pop(source, n) - n):
            self.counts[source, SUPERSEDED] = gone
        return good, refused

    def report(self, spark: SparkSession) -> DataFrame:
        """One line per source and outcome that occurred."""
        return spark.createDataFrame([(self.job, s, o, n) for (s, o), n in sorted(self.counts.items()) if n], SCHEMA)

    def rejects(self) -> DataFrame:
        """All refused rows that are kept: source, filing_id, amend_id, reason."""
        out = self.refused[0]
        for df in self.refused[1:]:
            out = out.unionByName(df)
        return out
