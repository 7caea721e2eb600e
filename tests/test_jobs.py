import pytest
from conftest import TESTDATA

from fireledger.__main__ import main
from fireledger.operators import audits
from fireledger.plans import calendar, gases, location, reports
from fireledger.plans.fact import emission_fact
from fireledger.plans.refresh import refresh, refresh_from_files
from fireledger.plans.star import TableStar
from fireledger.registry import standin
from fireledger.schemas import RAW_COUNTRIES, RAW_GASES, TABLES
from fireledger.session import work_folder
from fireledger.sources import read_tables, write_csv

COUNTRIES = [
    ("Italy", "IT", "ITA", "380", "Europe", "Southern Europe", "150", "039"),
    ("Albania", "AL", "ALB", "008", "Europe", "Southern Europe", "150", "039"),
    ("Namibia", "NA", "NAM", "516", "Africa", "Sub-Saharan Africa", "002", "202"),
    ("Antarctica", "AQ", "ATA", "010", None, None, None, None),
]
FIRES = [
    ("ITA", "co2", 1.5, 2015, 1),
    ("ITA", "ch4", 2.25, 2015, 2),
    ("ALB", "co2", 4.0, 2016, 1),
    ("ATA", "co2", 8.0, 2016, 1),
    ("???", "co2", 16.0, 2016, 1),
    ("ITA", "smoke", 32.0, 2016, 1),
    ("ITA", "co2", 64.0, None, None),
    ("ITA", "co2", None, 2016, 12),
]


@pytest.fixture
def countries(spark):
    return spark.createDataFrame(COUNTRIES, RAW_COUNTRIES)


@pytest.fixture
def fires(spark):
    return spark.createDataFrame(
        FIRES, "alpha_3 string, gas string, emissions_quantity double, year int, month int"
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_country_keeps_the_list(countries, fires):
    totals = location.country_totals(fires, countries)
    assert rows(totals) == rows(totals.sparkSession.createDataFrame(
        [("380", 99.75), ("008", 4.0), ("010", 8.0), (None, 16.0)], totals.schema))
    dim = {r.code: r for r in location.country_dim(countries, totals).collect()}
    assert len(dim) == 4
    assert dim["008"].total_gas_emission == 4.0 and dim["516"].total_gas_emission is None
    assert dim["010"].region_code is None and dim["516"].alpha_2 == "NA"


def test_regions_and_continents_without_the_unplaced(countries, fires):
    totals = location.region_totals(fires, countries)
    assert rows(totals) == [("039", 103.75)]
    regions = location.region_dim(countries, totals)
    assert rows(regions.select("code", "name", "continent_code", "total_gas_emission")) == [
        ("039", "Southern Europe", "150", 103.75),
        ("202", "Sub-Saharan Africa", "002", None),
    ]
    assert rows(location.continent_dim(countries)) == [("002", "Africa"), ("150", "Europe")]


def test_years_and_months(fires):
    years = calendar.year_dim(fires)
    assert rows(years) == [(0, None, 64.0), (2015, 2015, 3.75), (2016, 2016, 60.0)]
    months = calendar.month_dim(fires, years)
    assert rows(months) == [
        (0, None, None, None),
        (201501, "January", 1, 2015),
        (201502, "February", 2, 2015),
        (201601, "January", 1, 2016),
        (201612, "December", 12, 2016),
    ]
    assert (2016, 1, 201601, 2016) in rows(calendar.time_lookup(months, years))


def test_an_earlier_year_leaves_keys_as_they_are(spark, fires):
    earlier = fires.unionByName(spark.createDataFrame([("ITA", "co2", 1.0, 1999, 12)], fires.schema))
    for make in (calendar.year_dim, lambda f: calendar.month_dim(f, calendar.year_dim(f))):
        before, after = (set(rows(make(f).drop("total_gas_emission"))) for f in (fires, earlier))
        assert before < after


def test_gases_are_known_by_label(spark):
    listed = [("Nitrous oxide", "n2o"), ("Methane", "ch4")]
    one, both = (spark.createDataFrame(x, RAW_GASES) for x in (listed[:1], listed))
    assert set(rows(gases.gas_dim(one))) < set(rows(gases.gas_dim(both)))
    assert len({r.id for r in gases.gas_dim(both).collect()}) == 2


def test_fact_keeps_every_record(spark, countries, fires):
    dim = location.country_dim(countries, location.country_totals(fires, countries))
    gas = gases.gas_dim(spark.createDataFrame([("Carbon", "co2"), ("Methane", "ch4")], RAW_GASES))
    years = calendar.year_dim(fires)
    lookup = calendar.time_lookup(calendar.month_dim(fires, years), years)
    fact = emission_fact(fires, dim, gas, lookup)
    co2, ch4 = (gas.where(f"chemical_label = '{x}'").first().id for x in ("co2", "ch4"))
    got = rows(fact.select("quantity", "country_code", "month_id", "gas_id", "year"))
    assert got == sorted(
        [
            (1.5, "380", 201501, co2, 2015),
            (2.25, "380", 201502, ch4, 2015),
            (4.0, "008", 201601, co2, 2016),
            (8.0, "010", 201601, co2, 2016),
            (16.0, None, 201601, co2, 2016),
            (32.0, "380", 201601, None, 2016),
            (64.0, "380", None, co2, None),
            (None, "380", 201612, co2, 2016),
        ],
        key=repr,
    )
    assert fact.select("id").distinct().count() == len(FIRES)


def given_raw(spark, scale="sf0.001"):
    given = standin.Given(spark, str(TESTDATA / scale))
    return standin.raw_fires(given), standin.raw_countries(given), standin.raw_gases(given)


@pytest.fixture(scope="module")
def refreshed(spark):
    folder = work_folder(spark)
    raw = given_raw(spark)
    return raw, "r_" + folder[-12:], folder, refresh(*raw, "r_" + folder[-12:], folder)


def test_refresh_gives_typed_tables_and_valid_keys(refreshed):
    _, database, _, tables = refreshed
    assert tables.keys() == TABLES.keys()
    for name, table in tables.items():
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in TABLES[name]]
    assert audits.primary_key_report(tables).count() == 0
    assert all(r.nulls == 0 for r in audits.not_null_report(tables).collect())
    orphans = audits.foreign_key_report(tables).collect()
    assert orphans and all(r.key_value is None for r in orphans)


def test_refresh_keeps_the_whole(refreshed):
    raw, _, _, tables = refreshed
    assert tables["gas_emission"].count() == raw[0].count()
    star = TableStar(tables)
    fires = star.emissions(["quantity"], None).selectExpr("sum(quantity)").first()[0]
    years = tables["year"].selectExpr("sum(total_gas_emission)").first()[0]
    assert abs(fires - years) < 1e-6 * years


def test_refresh_again_changes_nothing(refreshed):
    raw, database, folder, tables = refreshed
    before = {name: rows(table) for name, table in tables.items()}
    after = {name: rows(table) for name, table in refresh(*raw, database, folder).items()}
    assert after == before


def test_refresh_from_csv_files(spark, refreshed):
    raw, database, _, _ = refreshed
    tables = read_tables(spark, database)
    folder = work_folder(spark)
    for name, df in zip(("fires", "countries", "gases"), raw):
        write_csv(df, f"{folder}/raw/{name}", files=2)
    paths = [f"{folder}/raw/{name}" for name in ("fires", "countries", "gases")]
    again = refresh_from_files(spark, *paths, "c_" + folder[-12:], folder)
    for name in TABLES:
        assert rows(again[name].drop("id")) == rows(tables[name].drop("id"))


def test_star_reads_one_year_and_accepts_a_fact_without_it(spark, refreshed):
    tables = read_tables(spark, refreshed[1])
    star = TableStar(tables)
    plan = star.totals("month_id", year=1998)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    plain = TableStar({**tables, "gas_emission": tables["gas_emission"].drop("year")})
    assert rows(plain.total_by("continent", "gas", "year")) == rows(star.total_by("continent", "gas", "year"))


def test_command_line(spark, refreshed):
    raw, database, _, _ = refreshed
    folder = work_folder(spark)
    for name, df in zip(("fires", "countries", "gases"), raw):
        write_csv(df, f"{folder}/raw/{name}")
    paths = [f"{folder}/raw/{name}" for name in ("fires", "countries", "gases")]
    exports = ["--csv", f"{folder}/csv", "--cleaned-csv", f"{folder}/cleaned", "--audits", f"{folder}/audits"]
    for _ in range(2):
        main(["refresh", *paths, "--database", "cli", "--work", f"{folder}/work", *exports])
    left = {f.split("/work/")[1].split("/")[0] for f in spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").format("binaryFile").load(f"{folder}/work").select("path").toPandas()["path"]}
    assert left == {"cleaned", "monthly", "countries", "lookup"}
    assert spark.read.csv(f"{folder}/cleaned", header=True).count() == raw[0].count()
    assert spark.read.csv(f"{folder}/audits/foreign_key", header=True).count() > 0
    main(["audit", "not_null", f"{folder}/nulls", "--database", "cli"])
    assert {r.nulls for r in spark.read.csv(f"{folder}/nulls", header=True).collect()} == {"0"}
    main(["chart", "shares", f"{folder}/shares", "dimension=gas", "--database", "cli"])
    assert spark.read.csv(f"{folder}/shares", header=True).count() > 1
    main(["report", "ranked_countries", f"{folder}/asia", "continent=ASIA", "year=1998", "--database", "cli"])
    asia = reports.ranked_countries(TableStar(read_tables(spark, "cli")), "ASIA", 1998)
    assert spark.read.csv(f"{folder}/asia", header=True).count() == asia.count() > 0
    with pytest.raises(SystemExit, match="not name=value"):
        main(["report", "ranked_countries", f"{folder}/asia", "colour=red", "--database", "cli"])
    main(["report", "continent_ranges", f"{folder}/report", "--database", "cli"])
    exported = spark.read.csv(f"{folder}/csv/year", header=True)
    assert exported.count() == read_tables(spark, database)["year"].count()
    expected = reports.continent_ranges(TableStar(read_tables(spark, database)))
    written = spark.read.csv(f"{folder}/report", header=True, schema=expected.schema)
    assert rows(written) == rows(expected)
