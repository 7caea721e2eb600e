from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fireledger.functions.totals import total_by

QUANTITIES = st.integers(-(10**13), 10**13).map(lambda n: n / 1000)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from("ab"), st.none() | QUANTITIES), min_size=1, max_size=30))
def test_sums_are_exact(spark, rows):
    df = spark.createDataFrame(rows, "k string, q double").repartition(4)
    got = {r.k: (r.total, r.n) for r in total_by(df, "k", value="q", records="n").collect()}
    for key in {k for k, _ in rows}:
        values = [Decimal(repr(q)) for k, q in rows if k == key and q is not None]
        expected = sum(values).quantize(Decimal("0.001")) if values else None
        assert got[key] == (expected, len(values))


def test_sum_beyond_a_long_of_thousandths(spark):
    df = spark.range(4000).selectExpr("double(9e12) as q")
    assert total_by(df, value="q").first().total == Decimal("3.6e16")


def test_sum_of_more_records_than_a_long_of_thousandths_holds(spark):
    df = spark.range(2_200_000_000).selectExpr("4294967.295D * 1000 as q")
    assert total_by(df, value="q").first().total == 2_200_000_000 * Decimal("4294967295")


def test_totals_of_totals(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2), ("b", 1, 0.3)], "k string, m int, q double")
    once = total_by(df, "k", "m", value="q", out="q")
    assert {r.k: r.q for r in total_by(once, "k", value="q", out="q").collect()} == {
        "a": Decimal("0.300"),
        "b": Decimal("0.300"),
    }


def test_values_that_do_not_fit_raise(spark):
    df = spark.createDataFrame([(float("inf"),)], "q double")
    with pytest.raises(Exception, match="OVERFLOW"):
        total_by(df, value="q").collect()
