"""Quality rules as a ledger: each rule is evaluated once, its failures are bits of one number.

A ledger row keeps the measurements and the failure bits of a text. Policies are named masks over the bits,
so a new policy, or a rule taken out, is a bitwise operation on the ledger and reads no text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingloom.llm.common import documents, free_name, importable

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123)])
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper"]
MEASURE_TYPE = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

# A rule fails if its condition holds; its place in this list is its bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "100 * n_symbols > 20 * n_words",
    "shouting": "100 * n_upper > 60 * n_letters",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "odd_word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
}
BASE = ["few_words", "repeated_windows"]
POLICIES: dict[str, list[str]] = {"base": BASE, "v1": [*BASE, "many_symbols", "shouting"], "v2": list(RULES)}


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of so many words that occurs twice or more in the text."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n = len(words) - window + 1
    key = ids[:n]
    for k in range(1, window):
        if k > 1:  # number the shorter windows anew, so that the key stays in 64 bits
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(number) + ids[k : k + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n + 1, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    text = text or ""
    data = text.encode()
    words = data.split()  # splits bytes at exactly the six ASCII white space characters
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, _SPACES))),
        len(data) - len(data.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, _LETTERS)),
        len(data) - len(data.translate(None, _UPPER)),
    )


@F.arrow_udf(MEASURE_TYPE)
def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        rows = [measure_text(t.as_py()) for t in batch]
        columns = np.array(rows, np.int64).reshape(len(rows), len(MEASURES)).T
        yield pa.StructArray.from_arrays([pa.array(c) for c in columns], names=MEASURES)


def failure_bits(rules: dict[str, str], measures: str) -> Column:
    """The failures of all rules as one number, bit k for the k-th rule."""
    if len(rules) > 63:
        raise ValueError("a ledger row has 63 bits")
    bits = F.lit(0).cast("bigint")
    for k, condition in enumerate(rules.values()):
        own = condition
        for m in MEASURES:
            own = own.replace(m, f"{measures}.{m}")
        bits = bits.bitwiseOR(F.when(F.expr(own), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def policy_mask(names: list[str], rules: dict[str, str] = RULES) -> int:
    return sum(1 << list(rules).index(n) for n in names)


def with_ledger(docs: DataFrame, text_col: str = "text", rules: dict[str, str] = RULES) -> tuple[DataFrame, str, str]:
    """Documents with a struct of measurements and a number of failure bits; returns the frame and the two names.

    A null text counts as empty, and an empty one has no words. Each row is measured for itself: ids may be null or
    repeat. All columns are kept; the two new ones get names that the frame does not have.
    """
    importable(docs.sparkSession)
    measures, failures = free_name(docs, "measures"), free_name(docs, "failures")
    docs = docs.withColumn(measures, measured(F.col(text_col)))
    return docs.withColumn(failures, failure_bits(rules, f"`{measures}`")), measures, failures


def kept_by(docs: DataFrame, policy: str = "v2", text_col: str = "text") -> DataFrame:
    """The documents that no rule of a policy rejects, with their own columns only."""
    ledger, _, failures = with_ledger(docs, text_col)
    return ledger.filter(F.col(failures).bitwiseAND(F.lit(policy_mask(POLICIES[policy]))) == 0).select(*[f"`{c}`" for c in docs.columns])


def ablations(ledger: DataFrame, failures: str = "failures", rules: dict[str, str] = RULES, policies: dict[str, list[str]] = POLICIES) -> DataFrame:
    """For each policy and rule of it: rows rejected, rows that the rule fails, and rows kept if the rule is taken out.

    The ledger is first counted by failure bits, of which there are few; everything else is bitwise on those counts.
    """
    counts = ledger.groupBy(F.col(failures).alias("bits")).agg(F.count("*").alias("n"))
    listed = [F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(policy_mask(names, rules)).cast("bigint").alias("mask"),
                       F.lit(policy_mask([r], rules)).cast("bigint").alias("bit")) for p, names in policies.items() for r in names]
    each = counts.select("bits", "n", F.explode(F.array(*listed)).alias("p")).select("bits", "n", "p.*")
    failed = F.col("bits").bitwiseAND(F.col("mask"))
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        total(failed != 0).alias("rejected"), total(failed.bitwiseAND(F.col("bit")) != 0).alias("failed"), total(failed == F.col("bit")).alias("only_this_rule"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, with the verdict of the base rules and of policy v2."""
    ledger, m, failures = with_ledger(documents(spark, sf_dir))
    fails = lambda policy: F.col(failures).bitwiseAND(F.lit(policy_mask(POLICIES[policy]))) != 0
    return ledger.select("doc_id", *[F.col(f"{m}.{x}").alias(x) for x in MEASURES[:5]], fails("base").alias("base_failed"),
                         (~fails("base") & ~fails("v2")).alias("kept"), F.col(failures).alias("failures"))


# Words are numbered in their text; a window repeats if its words occur twice; its words are then joined back by place.
OP7_SQL = r"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
           FROM documents),
m AS (SELECT doc_id, len(ws) AS n_words,
             length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
             length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS n_letters,
             length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper
      FROM w),
g AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos
      FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g) WHERE n > 1),
q AS (SELECT m.*, coalesce(n, 0) AS n_repeat_words
      FROM m LEFT JOIN (SELECT doc_id, count(DISTINCT pos) AS n FROM r GROUP BY doc_id) USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END)
        + (CASE WHEN 100 * n_upper > 60 * n_letters THEN 8 ELSE 0 END)
        + (CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 16 ELSE 0 END)
        + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 32 ELSE 0 END) AS failures
      FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures % 4 <> 0 AS base_failed, failures = 0 AS kept, CAST(failures AS BIGINT) AS failures
FROM f
"""
