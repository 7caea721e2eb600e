from pathlib import Path

import pytest

from fireledger.schemas import RAW_COUNTRIES, RAW_FIRES, TABLES, conform
from fireledger.session import work_folder
from fireledger.sources import create_tables, overwrite_table, read_csv, read_tables, write_csv


def test_columns_are_found_by_name(spark, tmp_path):
    file = tmp_path / "countries.csv"
    file.write_text(
        "country-code,extra,name,alpha-2,alpha-3,region,sub-region,region-code,sub-region-code\n"
        "008,x,Albania,AL,ALB,Europe,Southern Europe,150,039\n"
        '516,x,"Namibia, Republic",NA,NAM,Africa,Sub-Saharan Africa,002,202\n'
        "010,x,Antarctica,AQ,ATA,,,,\n"
    )
    rows = {r["name"]: r for r in read_csv(spark, str(file), RAW_COUNTRIES).collect()}
    assert rows["Albania"]["country-code"] == "008"
    assert rows["Namibia, Republic"]["alpha-2"] == "NA"
    assert rows["Antarctica"]["region"] is None and rows["Antarctica"]["sub-region-code"] is None
    assert list(rows["Albania"].asDict()) == RAW_COUNTRIES.names


def test_bad_number_is_null(spark, tmp_path):
    file = tmp_path / "fires.csv"
    names = RAW_FIRES.names
    good = ["ITA", "s", "t", "t", "m", "co2", "1.25", "0.5", '"POLYGON((1 2,3 4))"']
    bad = [*good[:6], "much", *good[7:]]
    file.write_text("\n".join([",".join(names), ",".join(good), ",".join(bad)]) + "\n")
    rows = read_csv(spark, str(file), RAW_FIRES).collect()
    assert [r.emissions_quantity for r in rows] == [1.25, None]
    assert rows[0].st_astext == "POLYGON((1 2,3 4))"


def test_missing_column_and_other_header_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name\nCO2\n")
    with pytest.raises(ValueError, match="chemical-label"):
        read_csv(spark, str(tmp_path / "a.csv"), conform_schema("name", "chemical-label"))
    both = tmp_path / "both"
    both.mkdir()
    (both / "1.csv").write_text("name,label\nCO2,co2\n")
    (both / "2.csv").write_text("label,name\nch4,CH4\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(both), conform_schema("name", "label")).collect()


def conform_schema(*names):
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([StructField(n, StringType()) for n in names])


def test_write_csv_replaces_and_bounds_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.range(1000), path)
    write_csv(spark.range(100, numPartitions=8), path, files=5)
    assert len(list(Path(path).glob("part-*.csv"))) == 5
    assert spark.read.csv(path, header=True).count() == 100


def test_conform_orders_and_casts(spark):
    df = spark.createDataFrame([(7, "x", "3")], "value long, name string, id string")
    out = conform(df.selectExpr("id", "value", "0 as total_gas_emission"), TABLES["year"])
    assert [f.dataType for f in out.schema] == [f.dataType for f in TABLES["year"]]


@pytest.fixture
def database(spark):
    folder = work_folder(spark)
    name = "t_" + folder[-12:]
    create_tables(spark, name, location=folder)
    return name


def test_tables_have_declared_types_and_start_empty(spark, database):
    for name, table in read_tables(spark, database).items():
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in TABLES[name]]
        assert table.count() == 0
    create_tables(spark, database)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrite_drops_old_partitions(spark, database, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        columns = "id long, quantity double, country_code string, month_id long, gas_id long, year int"
        old = [(1, 1.0, "a", 1, 1, 2015), (2, 2.0, "a", 2, 1, 2016), (3, 2.0, None, None, None, None)]
        overwrite_table(spark.createDataFrame(old, columns), database, "gas_emission")
        assert spark.table(f"{database}.gas_emission").count() == 3
        new = overwrite_table(spark.createDataFrame(old[:1], columns), database, "gas_emission")
        assert [tuple(r) for r in new.collect()] == old[:1]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
