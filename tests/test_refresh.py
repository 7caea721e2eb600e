"""Versions, incremental refreshes, ids by content and stored aggregates."""

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from fireledger.operators import numbering
from fireledger.operators.numbering import BITS, number_by_content
from fireledger.plans import refresh as refreshing
from fireledger.plans.refresh import read_aggregates, refresh, refresh_from_files
from fireledger.plans.star import Star, TableStar
from fireledger.registry import standin
from fireledger.registry.queries import registered
from fireledger.schemas import AGGREGATES, RAW_FIRES, TABLES
from fireledger.session import work_folder
from fireledger.sources import overwrite_tables, read_csv, read_tables, split_csv, versions, write_csv

SMALL, MEDIUM = str(TESTDATA / "sf0.001"), str(TESTDATA / "sf0.01")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def content(spark, database):
    return {name: rows(table) for name, table in read_tables(spark, database).items()}


def state(spark, database):
    names = [*versions.AGGREGATE_TABLES, "records", "monthly"]
    return {name: rows(versions.version_table(spark, database, name)) for name in names}


class Raw:
    """Raw CSV files of the small tables; the records of each year by themselves."""

    def __init__(self, spark):
        self.spark, self.folder = spark, work_folder(spark)
        given = standin.Given(spark, SMALL)
        self.fires = standin.raw_fires(given).withColumn("y", F.substring("start_time", 1, 4)).cache()
        write_csv(standin.raw_countries(given), f"{self.folder}/countries")
        write_csv(standin.raw_gases(given), f"{self.folder}/gases")
        self.database = "i_" + self.folder[-12:]

    def add(self, where, mode="append", folder="fires"):
        self.fires.where(where).drop("y").write.mode(mode).csv(f"{self.folder}/{folder}", header=True)

    def refresh(self, database=None, fires="fires", **options):
        database = database or self.database
        paths = [f"{self.folder}/{name}" for name in (fires, "countries", "gases")]
        refresh_from_files(self.spark, *paths, database, f"{self.folder}/steps-{database}", f"{self.folder}/wh-{database}", **options)
        return database


@pytest.fixture(scope="module")
def raw(spark):
    return Raw(spark)


def files_by_year(spark, database):
    found = {}
    for file in versions.version_table(spark, database, "gas_emission").inputFiles():
        found.setdefault(re.search(r"year=(\w+)", file).group(1), set()).add(file)
    return found


def test_added_files_are_merged(spark, raw):
    raw.add("y < '1999'")
    raw.refresh()
    first = files_by_year(spark, raw.database)
    assert set(first) == {"1995", "1996", "1997", "1998"}
    raw.add("y = '1999' OR y = 'junk'")
    raw.add("y = '1996' AND iso3_country IN ('S5', 'SRB')")
    raw.refresh()
    second = files_by_year(spark, raw.database)
    assert {y for y in first if first[y] == second[y]} == {"1995", "1997", "1998"}
    assert set(second) - set(first) == {"1999", "__HIVE_DEFAULT_PARTITION__"}
    whole = raw.refresh("w_" + raw.database[-10:])
    assert content(spark, raw.database) == content(spark, whole)
    assert state(spark, raw.database) == state(spark, whole)
    # Nothing new: the same version.
    number = versions.current_number(spark, raw.database)
    raw.refresh()
    assert versions.current_number(spark, raw.database) == number
    refreshing.export_cleaned(spark, raw.database, f"{raw.folder}/steps-{raw.database}", f"{raw.folder}/cleaned")
    read = read_csv(spark, f"{raw.folder}/fires", RAW_FIRES).count()
    assert spark.read.csv(f"{raw.folder}/cleaned", header=True).count() == read


def test_changed_lists_and_files(spark, raw):
    """A new list of countries changes all keys; a replaced file of records starts anew."""
    countries = standin.raw_countries(standin.Given(spark, SMALL))
    write_csv(countries.where("`alpha-3` <> 'S7'"), f"{raw.folder}/countries")
    raw.refresh()
    whole = raw.refresh("x_" + raw.database[-10:])
    assert content(spark, raw.database) == content(spark, whole)
    raw.add("y = '1997'", mode="overwrite")
    raw.refresh()
    assert set(files_by_year(spark, raw.database)) == {"1997"}
    assert rows(read_tables(spark, raw.database)["year"].select("value")) == [(1997,)]


def test_a_stopped_refresh_leaves_the_tables_whole(spark, monkeypatch):
    folder, given = work_folder(spark), standin.Given(spark, SMALL)
    raw = standin.raw_fires(given), standin.raw_countries(given), standin.raw_gases(given)
    database = "s_" + folder[-12:]
    refresh(*raw, database, folder, f"{folder}/wh")
    before, number = content(spark, database), versions.current_number(spark, database)
    held = read_tables(spark, database)
    save, saved = versions.Draft.save, []

    def stopping(self, name, *args, **options):
        if sum(n in TABLES for n in saved) == 4:
            raise OSError("stopped")
        saved.append(name)
        return save(self, name, *args, **options)

    monkeypatch.setattr(versions.Draft, "save", stopping)
    fewer = raw[0].where("iso3_country <> 'S5'"), raw[1].limit(3), raw[2]
    with pytest.raises(OSError):
        refresh(*fewer, database, folder, f"{folder}/wh")
    assert versions.current_number(spark, database) == number and content(spark, database) == before
    assert rows(spark.table(f"{database}.country")) == before["country"]
    monkeypatch.undo()
    after = refresh(*fewer, database, folder, f"{folder}/wh")
    assert after["country"].count() == 3 and rows(spark.table(f"{database}.country")) == rows(after["country"])
    # Who holds the tables of the version before still reads them; those before that are gone.
    assert {name: rows(table) for name, table in held.items()} == before
    refresh(*raw, database, folder, f"{folder}/wh")
    assert content(spark, database) == before
    left = versions._children(spark, f"{folder}/wh")
    assert len([name for name in left if re.fullmatch(r"v\d+", name)]) == 1 + versions.KEPT


def test_ids_do_not_depend_on_files(spark):
    given, folder = standin.Given(spark, SMALL), work_folder(spark)
    fires = standin.raw_fires(given)
    doubled = fires.unionByName(fires.where("gas = 'UNLISTED'"))
    found = []
    for files in (1, 50):
        name = f"d{files}_" + folder[-10:]
        dealt = doubled.repartition(files)
        tables = refresh(dealt, standin.raw_countries(given), standin.raw_gases(given), name, f"{folder}/{name}", f"{folder}/wh{files}")
        found.append(rows(tables["gas_emission"]))
    assert found[0] == found[1] and len({r[0] for r in found[0]}) == len(found[0]) == doubled.count()
    by_year = {}
    for number, *_, year in found[0]:
        by_year.setdefault(year, []).append(number - ((year or 0) << BITS))
    assert all(sorted(numbers) == list(range(1, len(numbers) + 1)) for numbers in by_year.values())


def test_many_copies_are_numbered_in_slices(spark):
    contents = spark.createDataFrame([(1, "a", 200_000), (1, "b", 3), (None, "a", 65)], "s int, c string, n long")
    numbered = number_by_content(contents, "s", [F.col("c")], "n", "id", dealt_by="s")
    got = numbered.groupBy("s", "c").agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).collect()
    found = {(r[0], r[1]): tuple(r)[2:] for r in got}
    assert found[None, "a"] == (65, 65, 1, 65)
    assert {k: v[:2] for k, v in found.items()} == {(1, "a"): (200_000,) * 2, (1, "b"): (3, 3), (None, "a"): (65, 65)}
    assert min(v[2] for k, v in found.items() if k[0]) == (1 << BITS) + 1 and max(v[3] for v in found.values()) == (1 << BITS) + 200_003


@pytest.fixture(scope="module")
def warehouse(spark):
    folder, given = work_folder(spark), standin.Given(spark, MEDIUM)
    raw = standin.raw_fires(given), standin.raw_countries(given), standin.raw_gases(given)
    database = "a_" + folder[-12:]
    return refresh(*raw, database, folder, f"{folder}/wh"), read_aggregates(spark, database)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


FROM_AGGREGATES = [
    n for n in registered() if re.match(r"wh_(q0[1-6]|q09_moving_avg_months|q1[01]|chart_)", n)
]


@pytest.mark.parametrize("name", FROM_AGGREGATES)
def test_reports_read_no_fact(spark, name):
    text = plan(registered()[name](spark, SMALL))
    assert re.search(r"FileScan parquet \S*\.(cube|by_\w+)\[", text) and not re.search(r"FileScan parquet \S*\.(gas_emission|records)\[", text)


def test_totals_of_aggregates_are_those_of_the_fact(warehouse):
    tables, aggregates = warehouse
    assert set(aggregates) == set(AGGREGATES)
    stored, plain = TableStar(tables, aggregates), TableStar(tables)
    asked = [((), {}), (("country_code",), {"records": "n"}), (("gas_id", "year"), {"complete": True}), (("month_id",), {"year": 1998}), (("country_code", "month_id"), {"year": 1995, "complete": True})]
    for keys, options in asked:
        for complete in {False, options.get("complete", False)}:
            given = {**options, "complete": complete}
            assert rows(stored.totals(*keys, **given)) == rows(Star.totals(plain, *keys, **given))
    assert ".by_gas_year[" in plan(stored.totals("gas_id")) and ".by_country_gas_year[" in plan(stored.totals("gas_id", "country_code"))


def test_months_prune_the_files_when_the_query_runs(warehouse):
    tables, _ = warehouse
    star = TableStar(tables)
    top = star.years.agg(F.max("total_gas_emission")).scalar()
    df = star.emissions_during(["quantity", "year"], F.col("year_total") == top, F.col("month") <= 6)
    years = {r.year for r in df.collect()}
    text = plan(df)
    assert "dynamicpruning" in text and len(years) == 1
    scan = next(s for s in scans_of(df._jdf.queryExecution().executedPlan()) if "gas_emission" in s.nodeName())
    read = scan.metrics().get("numFiles").get().value()
    year = years.pop()
    of_year = [f for f in tables["gas_emission"].inputFiles() if f"year={year}/" in f]
    assert read == len(of_year) < len(tables["gas_emission"].inputFiles())


def scans_of(node):
    """The scans below a plan, through its adaptive stages."""
    name = node.getClass().getSimpleName()
    inner = []
    if name == "AdaptiveSparkPlanExec":
        inner = [node.executedPlan()]
    elif name.endswith("QueryStageExec"):
        inner = [node.plan()]
    else:
        children = node.children()
        inner = [children.apply(i) for i in range(children.size())]
    found = [node] if name == "FileSourceScanExec" else []
    return found + [s for child in inner for s in scans_of(child)]


def test_good_and_quarantined_lines_are_all_lines(spark, tmp_path):
    names = RAW_FIRES.names
    good = ["ITA", "s", "2015-01-01 00:00:00", "t", "m", "co2", "1.25", "0.5", '"POLYGON((1 2,3 4))"']
    lines = [good, [*good[:6], "much", *good[7:]], good, [*good, "extra"], good[:4], [*good[:6], "", *good[7:]]]
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("\n".join([",".join(names), *(",".join(x) for x in lines)]) + "\n")
    rows, bad, counts = split_csv(spark, str(tmp_path), RAW_FIRES, f"{work_folder(spark)}/split")
    assert counts == {"good": 9, "quarantined": 9} == {"good": rows.count(), "quarantined": bad.count()}
    assert rows.schema == RAW_FIRES and {r.emissions_quantity for r in rows.collect()} == {1.25, None}
    found = bad.collect()
    assert {r.line for r in found} == {",".join(x) for x in (lines[1], lines[3], lines[4])}
    assert {r.file.rsplit("/", 1)[1] for r in found} == {"0.csv", "1.csv", "2.csv"}


def test_refresh_with_a_quarantine(spark):
    raw = Raw(spark)
    raw.add("y = '1995'")
    spoilt = raw.fires.where("y = '1996'").drop("y").withColumn("emissions_factor", F.lit("high"))
    spoilt.write.mode("append").csv(f"{raw.folder}/fires", header=True)
    aside = f"{raw.folder}/aside"
    raw.refresh(quarantine=aside)
    assert rows(read_tables(spark, raw.database)["year"].select("value")) == [(1995,)]
    held = spark.read.parquet(f"{aside}/v1").where("_bad = 'true'")
    assert held.count() == spoilt.count() > 0


@pytest.mark.parametrize(
    "row, rule",
    [((None, "Europe"), "continent.code is NULL"), (("150" * 17, "Europe"), "continent.code holds more than 3 characters: 51")],
)
def test_rows_that_break_a_rule_stop_the_write(spark, row, rule):
    name = "o_" + work_folder(spark)[-12:]
    good = spark.createDataFrame([("150", "Europe")], TABLES["continent"])
    overwrite_tables(spark, name, {"continent": good}, work_folder(spark), rules=True)
    bad = spark.createDataFrame([("002", "Africa"), row], TABLES["continent"])
    with pytest.raises(Exception, match=rule):
        overwrite_tables(spark, name, {"continent": bad}, rules=True)
    assert rows(read_tables(spark, name)["continent"]) == [("150", "Europe")]
    assert overwrite_tables(spark, name, {"continent": bad})["continent"].count() == 2


def test_buckets_of_a_partitioned_table_follow_its_files(spark, warehouse, monkeypatch):
    fact = warehouse[0]["gas_emission"]
    files = sum(r[0] for r in spark.read.format("binaryFile").load(fact.inputFiles()).select("length").collect())
    assert files <= numbering._bytes(fact) < files * 1.1 and numbering._digits(files) < 5
    ids = fact.withColumn("n", F.lit(1))

    def placed():
        return numbering.place_by_content(ids, "year", [F.col("id")], "n")

    plan = placed()._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert any("md5" in x for x in plan) and not any("_digest" in x and "Exchange" in x for x in plan)
    few = {(r["id"], r["first_number"]) for r in placed().collect()}
    monkeypatch.setattr(numbering, "TASK", 1000)
    monkeypatch.setattr(numbering, "BUCKET", 1000)
    assert f", {-(-numbering._bytes(fact) // 1000)})" in placed()._jdf.queryExecution().executedPlan().toString()
    assert {(r["id"], r["first_number"]) for r in placed().collect()} == few
