"""What the plans must look like to hold at scale."""

import re

import pytest
from conftest import TESTDATA

from fireledger.plans import reports
from fireledger.plans.cleaning import clean_fires
from fireledger.plans.refresh import refresh
from fireledger.plans.star import TableStar
from fireledger.registry import standin
from fireledger.registry.queries import registered
from fireledger.session import stage, work_folder

FOLDER = str(TESTDATA / "sf0.001")
REPORTS = sorted(n for n in registered() if re.match(r"q\d\d_|chart_", n))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    """The final adaptive plan, after a run."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def scans(text: str, column: str) -> int:
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", text))


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registered()[name](spark, FOLDER))
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name", ["q02_literal", "q05_rank_asia", "q07_above_global_avg", "q09_moving_avg_records"])
def test_quantities_are_scanned_once(spark, name):
    folder = str(TESTDATA / "sf0.01")
    assert scans(executed(registered()[name](spark, folder)), "l_extendedprice") == 1


def test_share_takes_the_whole_from_the_same_totals(spark):
    df = registered()["chart_share"](spark, FOLDER)
    df.collect()
    assert re.search(r"ReusedExchange \[gas#", plan(df))


@pytest.mark.parametrize("name", ["q02_literal", "q03_max_yoy_increase", "q06_top3_by_gas_year", "q08_largest_record"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    text = plan(registered()[name](spark, FOLDER))
    assert "WindowGroupLimit" in text


def test_year_reaches_the_scan(spark):
    text = plan(registered()["q05_rank_asia"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate,2000-01-01" in text


def test_reports_without_a_gas_do_not_read_parts(spark):
    for name in ("q03_max_yoy_increase", "q05_rank_asia", "q11_country_year_sum"):
        assert "p_type" not in plan(registered()[name](spark, FOLDER))


def test_records_are_summed_before_any_join(spark):
    text = plan(standin.StandInStar(spark, FOLDER).total_by("continent", "year"))
    above, below = text.split("partial_sum", 2)[1:]
    assert "Join" in above and "Join" not in below.split("FileScan")[0]


@pytest.fixture(scope="module")
def stored(spark):
    """Warehouse tables of the given data, with all dimensions small."""
    folder = work_folder(spark)
    given = standin.Given(spark, str(TESTDATA / "sf0.01"))
    raw = standin.raw_fires(given), standin.raw_countries(given), standin.raw_gases(given)
    return refresh(*raw, "p_" + folder[-12:], folder, f"{folder}/warehouse")


@pytest.mark.parametrize("with_year", [True, False])
def test_records_of_stored_tables_are_not_shuffled_for_a_join(stored, with_year):
    fact = stored["gas_emission"] if with_year else stored["gas_emission"].drop("year")
    star = TableStar({**stored, "gas_emission": fact})
    rows = star.emissions(["country_code", "month_id", "quantity", "year"])
    named = plan(star.named(rows, "continent", "month"))
    assert "SortMergeJoin" not in named and "Exchange hashpartitioning" not in named
    # The one shuffled join of the moving mean is that of its pieces.
    assert plan(reports.moving_mean_of_records(star, "NATION_1", 2000)).count("SortMergeJoin") <= 1


def test_fact_joins_stored_dimensions_without_a_shuffle(spark):
    text = plan(registered()["job_fact_emission"](spark, FOLDER))
    # Records are counted, and numbered in buckets of their content. No dimension moves them.
    joins = text.count("BroadcastHashJoin"), text.count("SortMergeJoin")
    assert joins in {(3, 1), (4, 0)}
    assert not re.search(r"hashpartitioning\((alpha_3|gas|_month|_year)#\d+,? ?\d*\)", text)


@pytest.mark.parametrize("name", ["q02_literal", "q07_above_global_avg", "q09_moving_avg_records", "job_dim_country"])
def test_results_do_not_depend_on_broadcasts(spark, name):
    """Dimensions above the threshold are joined by shuffle, with the same result."""
    query = registered()[name]
    folder = str(TESTDATA / "sf0.01")
    small = sorted(map(repr, query(spark, folder).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = query(spark, folder)
        assert sorted(map(repr, large.collect())) == small
        assert "SortMergeJoin" in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_time_and_polygon_are_parsed_once_per_record(spark):
    raw = standin.raw_fires(standin.Given(spark, FOLDER))
    staged = stage(raw, work_folder(spark), "raw")
    text = plan(clean_fires(staged))
    assert text.count("gettimestamp") + text.count("try_to_timestamp") <= 2
    assert text.count("regexp_extract") == 1


def test_stored_reports_read_records_once_and_join_no_part(spark):
    text = executed(registered()["wh_q08_largest_record"](spark, FOLDER))
    assert len(re.findall(r"FileScan parquet \S*gas_emission", text)) == 1
    assert "part.parquet" not in text and "lineitem.parquet" not in text
    assert "PartitionFilters: [isnotnull(year" in plan(registered()["wh_q09_moving_avg_records"](spark, FOLDER))
    assert "EqualTo(year,2000)" in executed(registered()["wh_q05_rank_asia"](spark, FOLDER))


def test_entry_runs(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).columns == ["gas_name", "country_name", "year", "total_emission"]
    assert registered().keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
