"""Reports and operators on hand-made rows, and against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from fireledger.operators.neighbours import centred_mean
from fireledger.operators.ranking import rank_large, top_ranked
from fireledger.plans import charts, reports
from fireledger.plans.star import TableStar

CONTINENTS = [("E", "Europe"), ("A", "Asia"), ("N", "America")]
REGIONS = [
    ("SE", "Southern Europe", None, "E"),
    ("EA", "Eastern Asia", None, "A"),
    ("NA", "Northern America", None, "N"),
]
COUNTRIES = [
    ("it", "Italy", "SE"),
    ("gr", "Greece", "SE"),
    ("jp", "Japan", "EA"),
    ("kr", "Korea", "EA"),
    ("us", "States", "NA"),
    ("aq", "Antarctica", None),
]
GASES = [(1, "Carbon", "co2"), (2, "Methane", "ch4"), (3, "Nitrous", "n2o")]


def month_key(year, month):
    return (year - 2000) * 12 + month


def make_star(spark, records):
    """records: (country, gas, year, month, quantity)"""
    times = sorted({(r[2], r[3]) for r in records if r[2]})
    years = sorted({y for y, _ in times})
    fact = [
        (i, q, c, month_key(y, m) if y else None, g, y) for i, (c, g, y, m, q) in enumerate(records, 1)
    ]

    def df(rows, columns):
        return spark.createDataFrame(rows, columns)

    return TableStar(
        {
            "continent": df(CONTINENTS, "code string, name string"),
            "region": df(REGIONS, "code string, name string, total_gas_emission double, continent_code string"),
            "country": df(COUNTRIES, "code string, name string, region_code string"),
            "year": df([(y - 1999, y, 0.0) for y in years], "id long, value int, total_gas_emission double"),
            "month": df(
                [(month_key(y, m), f"m{m}", m, y - 1999) for y, m in times],
                "id long, name string, num_value int, year_id long",
            ),
            "gas": df(GASES, "id long, name string, chemical_label string"),
            "gas_emission": df(
                fact, "id long, quantity double, country_code string, month_id long, gas_id long, year int"
            ),
        }
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_top_month_takes_one_of_a_tie(spark):
    star = make_star(spark, [("it", 1, 2015, 2, 5.0), ("it", None, 2015, 1, 5.0), ("it", 1, 2016, 1, 9.0)])
    assert rows(reports.top_month(star)) == [(5.0, month_key(2015, 1), "m1")]


def test_literal_and_stated_form_of_report_two(spark):
    star = make_star(
        spark,
        [
            ("it", 1, 2015, 1, 10.0),
            ("it", 2, 2015, 1, 6.0),
            ("it", 3, 2015, 1, 1.0),
            ("it", 1, 2016, 1, 3.0),
            ("it", None, 2016, 1, 100.0),
            ("it", 1, None, None, 1000.0),
            (None, 1, 2015, 1, 7.0),
            ("gr", 3, 2016, 1, 2.0),
        ],
    )
    assert rows(reports.country_total_per_top_gas(star)) == [
        ("Greece", 2016, 2.0),
        ("Italy", 2015, 2 * 1120.0),
        ("Italy", 2016, 1120.0),
    ]
    assert rows(reports.top_gases_running_total(star)) == [
        ("Greece", 2016, 2.0),
        ("Italy", 2015, 16.0),
        ("Italy", 2016, 19.0),
    ]


def test_largest_increase(spark):
    star = make_star(
        spark,
        [("it", 1, y, 1, q) for y, q in ((2015, 5.0), (2016, 8.0), (2018, 11.0), (2019, 1.0))]
        + [("jp", 1, 2015, 1, 9.0)]
        + [("us", 1, 2015, 1, 9.0), ("us", 1, 2016, 1, 7.0), ("us", 1, 2017, 1, 6.0)],
    )
    assert rows(reports.largest_yearly_increase(star)) == [
        ("America", 2017, -1.0),
        ("Europe", 2016, 3.0),
        ("Europe", 2018, 3.0),
    ]


def test_rank_change_and_direction(spark):
    star = make_star(
        spark,
        [("it", 1, y, 1, q) for y, q in ((2015, 5.0), (2016, 8.0), (2017, 8.0), (2019, 7.0), (2020, 1.0))]
        + [("gr", 1, 2015, 1, 1.0), ("gr", 1, 2017, 1, 1.0), ("jp", 1, 2015, 1, 1.0), ("jp", 1, 2016, 1, 2.0)],
    )
    assert rows(reports.rank_change(star)) == [
        ("Italy", 2015, "Decreased"),
        ("Italy", 2016, "Stable"),
        ("Italy", 2019, "Increased"),
    ]
    assert rows(reports.yearly_direction(star)) == [
        ("Italy", 2016, "Increased"),
        ("Italy", 2017, "Stable"),
        ("Italy", 2020, "Decreased"),
    ]
    assert ("Italy", 2020, "Stable") in rows(reports.yearly_direction(star, tolerance=0.9))


def test_ranked_countries(spark):
    star = make_star(
        spark,
        [("jp", 1, 2020, 1, 1.0), ("kr", 1, 2020, 2, 1.0), ("it", 1, 2020, 1, 9.0), ("jp", 1, 2019, 1, 5.0)],
    )
    assert rows(reports.ranked_countries(star)) == [(2020, "Japan", 1.0, 1), (2020, "Korea", 1.0, 1)]


def test_top_countries_keep_ties(spark):
    star = make_star(
        spark, [(c, 1, 2015, 1, q) for c, q in (("it", 9.0), ("gr", 8.0), ("jp", 7.0), ("kr", 7.0), ("us", 6.0))]
    )
    assert [r[1] for r in rows(reports.top_countries_by_gas(star))] == ["Greece", "Italy", "Japan", "Korea"]


def test_means_count_all_records_of_the_gas(spark):
    star = make_star(
        spark,
        [
            ("it", 1, 2015, 1, 9.0),
            ("it", 1, 2015, 1, None),
            ("gr", 1, 2015, 1, 2.0),
            (None, 1, 2015, 1, 1.0),
            ("it", None, 2015, 1, 99.0),
        ],
    )
    assert rows(reports.country_and_global_means(star)) == [
        ("Greece", "Carbon", 2.0, 4.0),
        ("Italy", "Carbon", 9.0, 4.0),
    ]
    assert rows(reports.above_global_mean(star)) == [("Italy", "Carbon", 9.0, 4.0)]


def test_largest_record_needs_all_names(spark):
    star = make_star(
        spark,
        [
            ("it", 1, 2015, 1, 5.0),
            ("gr", 1, 2015, 2, 5.0),
            (None, 1, 2015, 1, 50.0),
            ("it", 9, 2015, 1, 50.0),
            ("us", 2, 2016, 1, 1.0),
        ],
    )
    assert rows(reports.largest_records(star)) == [("Greece", 2015, "Carbon", 5.0), ("States", 2016, "Methane", 1.0)]


def test_moving_means(spark):
    quantities = [("us", 1, 2021, m, q) for m, q in ((1, 3.0), (1, 6.0), (2, 9.0), (3, None), (5, 12.0))]
    others = [("us", 1, 2020, 12, 50.0), ("it", 1, 2021, 1, 70.0), ("us", None, 2021, 1, 8.0)]
    star = make_star(spark, [*quantities, *others])
    months = rows(reports.moving_mean_of_months(star))
    assert [r[2:] for r in months] == [(1, "Carbon", 9.0), (2, "Carbon", 9.0), (3, "Carbon", 10.5), (5, "Carbon", 12.0)]
    records = reports.moving_mean_of_records(star).collect()
    assert [r.month for r in records] == [1, 1, 2, 3, 5]
    assert sorted(r.moving_avg for r in records if r.month == 1) == [4.5, 6.0]
    assert [r.moving_avg for r in records if r.month > 2] == [10.5, 12.0]


def test_continent_ranges_and_plain_sums(spark):
    star = make_star(
        spark,
        [("it", 1, 2015, 1, 5.0), ("gr", 1, 2016, 1, 2.0), ("jp", 1, 2015, 1, 1.0), ("aq", 1, 2015, 1, 40.0)],
    )
    assert [tuple(r) for r in reports.continent_ranges(star).collect()] == [("Europe", 3.0), ("Asia", 0.0)]
    assert ("Antarctica", 2015, 40.0) in rows(reports.country_year_totals(star))


def test_charts(spark):
    star = make_star(
        spark,
        [("it", 1, 2015, 1, 6.0), ("it", 2, 2015, 1, 1.0), ("jp", 1, 2015, 1, 3.0), (None, None, None, None, 90.0)],
    )
    assert rows(charts.grand_total(star)) == [(100.0,)]
    shares = [tuple(r) for r in charts.shares(star, "gas").collect()]
    assert shares == [(None, 90.0, 0.9), ("Carbon", 9.0, 0.09), ("Methane", 1.0, 0.01)]
    stacked = [
        ("Asia", "Carbon", 3.0, 3.0),
        ("Europe", "Carbon", 6.0, 7.0),
        ("Europe", "Methane", 1.0, 7.0),
        (None, None, 90.0, 90.0),
    ]
    assert [tuple(r) for r in charts.stacked(star, "continent", "gas").collect()] == stacked
    assert [tuple(r) for r in charts.stacked(star, "continent", "gas", limit=2).collect()] == stacked[:2]
    pairs = [
        (None, None, 90.0, 1),
        ("Carbon", "Italy", 6.0, 1),
        ("Carbon", "Japan", 3.0, 2),
        ("Methane", "Italy", 1.0, 2),
    ]
    assert [tuple(r) for r in charts.top_pairs(star, "gas", "country", page_rows=2).collect()] == pairs
    assert [tuple(r) for r in charts.top_pairs(star, "gas", "country", 3, page_rows=2).collect()] == pairs[:3]
    assert charts.bar_pairs(star, "gas", "country", limit=2).collect()[1].country == "Italy"


def test_rank_large_is_rank(spark):
    rng = random.Random(3)
    values = [None, 0.0, 0.001, -0.001, 1e15, -1e15]
    values += [rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 9) for _ in range(300)]
    data = [(g, v) for g in "ab" for v in values + [5.0] * 40]
    df = spark.createDataFrame(data, "g string, v double").selectExpr("g", "cast(v as decimal(38,3)) as v")
    expected = df.selectExpr("g", "v", "rank() over (partition by g order by v desc nulls last) as r")
    assert rows(rank_large(df, ["g"], "v", "r")) == rows(expected)


def test_top_ranked_puts_null_last(spark):
    df = spark.createDataFrame([("a", None), ("a", -1.0), ("b", None)], "g string, v double")
    assert rows(top_ranked(df, ["g"], "v", 1, "r")) == [("a", -1.0, 1), ("b", None, 1)]


@pytest.mark.parametrize("files", [1, 7])
def test_centred_mean_against_brute_force(spark, files, monkeypatch):
    monkeypatch.setattr("fireledger.operators.neighbours._SLICE", 16)
    rng = random.Random(5)
    data = []
    for i in range(900):
        group = "hot" if i % 3 else rng.choice("abcde")
        value = rng.choice([None, 2.5, rng.randrange(10**7) / 1000, -rng.randrange(10**5) / 1000])
        data.append((group, rng.randrange(1, 6), value))
    data += [(None, 1, 1.0), ("a", None, 1.0)]
    df = spark.createDataFrame(data, "g string, month int, v double").repartition(files)
    got = sorted(map(repr, centred_mean(df, ["g"], "month", "v", "m").collect()))

    groups = defaultdict(list)
    for g, month, v in data[:900]:
        groups[g].append((month, round(v * 1000) if v is not None else None))
    expected = []
    for g, members in groups.items():
        members.sort(key=lambda r: (r[0], r[1] is not None, r[1]))
        for n, (month, _) in enumerate(members):
            near = [w for _, w in members[max(n - 1, 0) : n + 2] if w is not None]
            expected.append(Row(g=g, month=month, m=sum(near) / 1000 / len(near) if near else None))
    assert got == sorted(map(repr, expected))


def test_centred_mean_deals_equal_values_out(spark):
    equal = spark.range(50_000).selectExpr("'g' as g", "1 as month", "2.5 as v")
    means = centred_mean(equal, ["g"], "month", "v", "m")
    filled = means.groupBy(F.spark_partition_id()).count().collect()
    assert len(filled) > 1
    assert sum(r["count"] for r in filled) == 50_000
