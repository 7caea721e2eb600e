"""Ties, ids and ordered files without a task that holds a large share."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fireledger.operators.audits import duplicate_keys
from fireledger.operators.ranking import number_large, rank_large
from fireledger.session import work_folder
from fireledger.sources import write_csv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def ties(spark):
    """One value in nearly all rows, and others and NULL beside it."""
    value = F.when(F.col("id") % 1000 == 0, F.col("id") / 7).when(F.col("id") % 1000 == 1, None).otherwise(5.0)
    return spark.range(60_000, numPartitions=7).select((F.col("id") % 2).alias("g"), value.alias("v"), F.pmod(F.xxhash64("id"), F.lit(40_000)).alias("t"))


def test_ranks_of_many_ties(ties):
    got = rank_large(ties, ["g"], "v", "r")
    order = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    assert rows(got) == rows(ties.withColumn("r", F.rank().over(order)))


def test_numbers_of_many_ties(spark, ties):
    for groups in ([], ["g"]):
        got = number_large(ties, groups, "v", "n", ["t", "g"])
        order = Window.partitionBy(*groups).orderBy(F.col("v").desc_nulls_last(), "t", "g")
        # Rows alike are interchangeable.
        assert rows(got) == rows(ties.withColumn("n", F.row_number().over(order)))


def test_no_task_numbers_most_ties(spark):
    """A million equal values, without anything that tells them apart."""
    alike = spark.range(1_000_000, numPartitions=8).select(F.lit(3.5).alias("v"))
    numbered = number_large(alike, [], "v", "n", []).withColumn("task", F.spark_partition_id())
    assert numbered.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (1_000_000, 1, 1_000_000)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = alike.withColumn("p", F.monotonically_increasing_id()).repartitionByRange(tasks, F.col("v").desc_nulls_last(), "p")
    assert share.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2 * 1_000_000 / tasks


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_duplicates_of_ids(spark, kind):
    ids = [*range(1, 40_000), -5, -5, 0, 7, 39_000, 39_000, None, None, -40_000]
    df = spark.createDataFrame([(i,) for i in ids], "id long").select(F.col("id").cast(kind).alias("id")).repartition(3)
    assert rows(duplicate_keys(df, "id")) == [("-5", 2), ("39000", 3), ("7", 2), (None, 2)]
    assert duplicate_keys(df.where("id IS NULL").limit(1), "id").count() == 0


def test_ids_are_shuffled_as_bits(spark):
    """What is dealt by id is only what shares a bitmap with a duplicate."""
    ids = spark.range(1, 300_001, numPartitions=4)
    df = duplicate_keys(ids.unionByName(spark.range(77, 78)), "id")
    assert rows(df) == [("77", 2)]
    written = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            written.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
        for child in children:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    assert written and max(written) < 33_000


@pytest.mark.parametrize("files", [1, 5])
def test_ordered_files_read_back_in_order(spark, files):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("k"), "id").repartition(6)
    path = work_folder(spark)
    write_csv(df, path, files=files, order=[F.col("k").desc(), "id"])
    read = spark.read.csv(path, header=True, schema=df.schema).select("*", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"))
    parts = {}
    for r in read.collect():
        parts.setdefault(re.search(r"part-(\d+)", r.f).group(1), []).append((r["at"], r.k, r.id))
    assert len(parts) == files
    back = [(k, i) for name in sorted(parts) for _, k, i in sorted(parts[name])]
    assert back == sorted(((r.k, r.id) for r in df.collect()), key=lambda x: (-x[0], x[1]))
