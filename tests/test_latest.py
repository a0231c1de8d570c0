import pytest
from support import rows
from pyspark.sql import functions as F

from filingloom.operators.latest import latest_amendment

FILINGS = [
    ("1", "2", "A", "x"), ("1", "9", "A", "x"), ("1", "10", "A", "x"), ("1", "10", "A", "y"), ("1", "10", "A", "y"),
    ("2", "0", "A", "x"), ("2", "1", "B", "x"), ("3", "", "A", "x"), ("3", None, "A", "z"),
    (None, "1", "A", "n"), (None, "2", "A", "n"),
]


@pytest.fixture
def filings(spark):
    return spark.createDataFrame(FILINGS, "filing string, amend string, form string, line string")


def test_ties_are_kept_and_numbers_ordered_as_numbers(filings):
    found = rows(latest_amendment(filings, "filing", "amend"))
    assert found == sorted([
        ("1", "10", "A", "x"), ("1", "10", "A", "y"), ("1", "10", "A", "y"), ("2", "1", "B", "x"),
        ("3", "", "A", "x"), ("3", None, "A", "z"), (None, "2", "A", "n"),
    ], key=repr)


def test_single_row_is_one_of_the_tied(filings):
    ties = set(rows(latest_amendment(filings, "filing", "amend")))
    single = rows(latest_amendment(filings, "filing", "amend", ties="single", tie_break=["line"]))
    assert len(single) == 4 and set(single) <= ties
    assert ("1", "10", "A", "x") in single


def test_filter_before_and_after_the_rank(filings):
    form = F.col("form") == "A"
    before = rows(latest_amendment(filings, "filing", "amend", where=form, rank_scope="form"))
    after = rows(latest_amendment(filings, "filing", "amend", where=form, rank_scope="filing"))
    assert ("2", "0", "A", "x") in before and not [r for r in after if r[0] == "2"]


def test_order_of_input_and_partitions_do_not_matter(spark, filings):
    expected = rows(latest_amendment(filings, "filing", "amend", ties="single"))
    for n in (1, 3, 7):
        shuffled = filings.repartition(n, "line").sort(F.rand(n))
        assert rows(latest_amendment(shuffled, "filing", "amend", ties="single")) == expected


def test_one_filing_with_a_third_of_all_rows(spark):
    """The hot filing's tied rows, copies included, all come back."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("filing"),
        F.when(F.col("id") % 6 == 0, "2").otherwise("1").alias("amend"),
    )
    latest = latest_amendment(df, "filing", "amend")
    assert latest.filter("filing = 'hot'").count() == 500
    assert latest.count() == 2500
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_bad_options(filings):
    with pytest.raises(ValueError):
        latest_amendment(filings, "filing", "amend", ties="some")
    with pytest.raises(ValueError):
        latest_amendment(filings, "filing", "amend", rank_scope="any")
