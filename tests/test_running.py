import random

import pytest
from pyspark.sql import functions as F

from cardledger.operators.hot import find_hot, lookup
from cardledger.operators.running import Measure, n_ranges, running


def data(spark, n=600):
    r = random.Random(n)
    ids = r.sample(range(10 * n), n)
    rows = [
        (None if i % 7 == 0 else 0 if r.random() < 0.4 else r.randint(1, 9), r.randint(0, 5), i, r.randint(-9, 9))
        for i in ids
    ]
    return rows, spark.createDataFrame(rows, "k long, d long, i long, v long")


def expected(rows):
    out, total, smallest = {}, {}, {}
    for k, _, i, v in sorted(rows, key=lambda x: x[1:3]):
        total[k] = total.get(k, 0) + v
        out[i] = (total[k], total[k] - v, smallest.get(k))
        smallest[k] = min(smallest.get(k, i), i)
    return out


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_running_values(spark, hot_rows):
    rows, df = data(spark)
    measures = {
        "total": Measure(F.col("v")),
        "before": Measure(F.col("v"), inclusive=False),
        "smallest": Measure(F.col("i"), "min", inclusive=False),
    }
    hot = find_hot(df, "k", hot_rows)
    assert (hot is None) == (hot_rows > 10**3)
    got = running(df, "k", ["d", "i"], measures, hot).collect()
    assert {r["i"]: (r["total"], r["before"], r["smallest"]) for r in got} == expected(rows)


def test_hot_key_is_spread_over_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20000).select(
        F.lit(1).cast("long").alias("k"), (F.col("id") % 50).alias("d"), F.col("id").alias("i")
    )
    got = running(
        df, "k", ["d", "i"], {"n": Measure(F.lit(1))},
        find_hot(df, "k", 100),
    )
    parts = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 20000 / 4
    assert got.agg(F.max("n"), F.countDistinct("n")).first()[:] == (20000, 20000)


def test_few_ranges_for_sparse_ids_and_null_levels(spark):
    """Ids far apart and rows without a day: as many ranges as the rows fill, one result."""
    df = spark.range(6000).selectExpr(
        "1L as k", "case when id % 5 > 0 then int(id % 3) end as d", "id * 1000000007 as i"
    )
    hot = find_hot(df, "k", 1000)
    assert n_ranges(hot) == 12
    split = running(df, "k", ["d", "i"], {"n": Measure(F.lit(1))}, hot)
    whole = running(df, "k", ["d", "i"], {"n": Measure(F.lit(1))}, None)
    assert {r["i"]: r["n"] for r in split.collect()} == {r["i"]: r["n"] for r in whole.collect()}


def test_key_of_dates_with_nulls(spark):
    df = spark.range(400).selectExpr(
        "case when id % 4 > 0 then date_add(date'2024-01-01', int(id % 2)) end as k", "id as i"
    )
    got = running(
        df, "k", ["i"], {"n": Measure(F.lit(1))}, find_hot(df, "k", 90)
    )
    by_key = {}
    for r in sorted(got.collect(), key=lambda r: r["i"]):
        by_key[r["k"]] = by_key.get(r["k"], 0) + 1
        assert r["n"] == by_key[r["k"]]


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_lookup(spark, hot_rows):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 40)
        .cast("long").alias("k"),
        F.col("id"),
    )
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = lookup(rows, dim, "k", find_hot(rows, "k", hot_rows))
    assert sorted(got.columns) == ["id", "k", "v"]
    for r in got.collect():
        assert r["v"] == (None if r["k"] is None or r["k"] >= 30 else r["k"] * 10)
    assert got.count() == 3000


def test_lookup_does_not_shuffle_rows_of_hot_keys(spark, conf):
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(9000, numPartitions=8).select(
        F.when(F.col("id") % 9 > 0, 5).otherwise(F.col("id") % 30).cast("long").alias("k"), "id"
    )
    dim = spark.range(30).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    got = lookup(rows, dim, "k", find_hot(rows, "k", 1000)).filter("v = 1")
    busy = got.filter("k = 5").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(busy) == 8 and max(r["count"] for r in busy) == 1000
    assert got.count() == 9000
