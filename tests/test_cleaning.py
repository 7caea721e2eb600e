from fireledger.plans.cleaning import clean_fires, monthly_quantities
from fireledger.schemas import CLEANED_FIRES, RAW_FIRES

RING = "POLYGON((1 2,-3 4,5 6.5,7 8,1 2))"


def cleaned(spark, *, code="ITA", time="2015-03-04 10:00:00", quantity=1.0, polygon=RING):
    row = (code, "sector", time, time, "month", "co2", quantity, 0.5, polygon)
    return clean_fires(spark.createDataFrame([row], RAW_FIRES)).first()


def coordinates(row):
    return [row[f"coordinates_{i}"] for i in range(1, 6)]


def test_columns_and_types(spark):
    df = clean_fires(spark.createDataFrame([], RAW_FIRES))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEANED_FIRES]


def test_polygons(spark):
    assert coordinates(cleaned(spark)) == ["1 2", "-3 4", "5 6.5", "7 8", "1 2"]
    for odd in (
        "POLYGON ((1 2,3 4,5 6,7 8,1 2))",
        "POLYGON((1 2,3 4,5 6,1 2))",
        "POLYGON((1 2,3 4,5 6,7 8,9 10,1 2))",
        "POLYGON((1e-05 2,3 4,5 6,7 8,1 2))",
    ):
        assert coordinates(cleaned(spark, polygon=odd)) == ["", None, None, None, None]
    assert coordinates(cleaned(spark, polygon=None)) == [None] * 5


def test_times(spark):
    row = cleaned(spark)
    assert (row.year, row.month) == (2015, 3)
    for bad in ("junk", "2015-03-04", "2015-02-30 00:00:00", None):
        row = cleaned(spark, time=bad)
        assert (row.year, row.month) == (None, None)


def test_codes_and_quantities(spark):
    assert cleaned(spark, code="XKX").alpha_3 == "SRB"
    assert cleaned(spark, code="ITA").alpha_3 == "ITA"
    assert cleaned(spark, quantity=1.0005).emissions_quantity == 1.001
    assert cleaned(spark, quantity=-2.3455).emissions_quantity == -2.346
    assert cleaned(spark, quantity=None).emissions_quantity is None


def test_no_shuffle(spark):
    df = clean_fires(spark.createDataFrame([], RAW_FIRES))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_monthly_quantities_keep_the_whole(spark):
    rows = [("A", 0.1, 2015, 1)] * 3 + [("A", 5.0, 2015, 2), ("B", 2.5, None, None), (None, 1.0, 2015, 1)]
    fires = spark.createDataFrame(rows, "alpha_3 string, emissions_quantity double, year int, month int")
    monthly = {tuple(r)[:3]: float(r.emissions_quantity) for r in monthly_quantities(fires).collect()}
    assert monthly == {("A", 2015, 1): 0.3, ("A", 2015, 2): 5.0, ("B", None, None): 2.5, (None, 2015, 1): 1.0}
