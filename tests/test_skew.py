"""The salted join and the sliced lag against their plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from breakwater.operators import skew, summarise
from breakwater.operators.skew import SkewPolicy
from conftest import TOUCHY


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_hot_keys_are_bounded_by_the_share(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    found = skew.hot_keys(df, ["k"], SkewPolicy(share=0.1, min_rows=1, fraction=1))
    assert found == [(0, 4)]  # 400 rows in groups of at most 100


def test_a_sample_finds_a_hot_key(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    found = skew.hot_keys(df, ["k"], SkewPolicy(share=0.01, min_rows=1000, fraction=0.01))
    assert [f[0] for f in found] == [-1]


def test_exact_copies_are_scattered(spark):
    df = spark.range(0, 4000, 1, 16).select(F.lit("k").alias("k"), F.lit(1).alias("v"))
    left, _, on = skew.salted(df, df.limit(1), ["k"], SkewPolicy(share=0.01, min_rows=1, fraction=1))
    assert on == ["k", skew.SALT]
    assert left.select(skew.SALT).distinct().count() > 5


def test_salted_lookup_equals_plain_join(spark):
    rng = random.Random(3)
    many = [(rng.choice(["a", "a", "a", "b", "c", None, None, f"x{i}"]), i) for i in range(300)]
    one = [(k, k.upper()) for k in ("a", "b", "d", "x7", "x8")] + [(None, "NONE")] * 5
    left = spark.createDataFrame(many, "k string, v int").repartition(6)
    right = spark.createDataFrame(one, "k string, w string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        columns = ["k", "v"] if "_" in how else ["k", "v", "w"]
        salted = skew.salted_lookup(left, right, ["k"], how, TOUCHY).select(*columns)
        assert _rows(salted) == _rows(left.join(right, ["k"], how).select(*columns))
    with pytest.raises(ValueError):
        skew.salted_lookup(left, right, ["k"], "full_outer", TOUCHY)


def test_sliced_lag_equals_one_window(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", f"k{i % 20}"]), i % 37, i, rng.choice("pqrs")) for i in range(500)]
    rows += [(None, 1, 1000 + i, "p") for i in range(4)]
    df = spark.createDataFrame(rows, "k string, t int, seq int, v string").repartition(4)
    plain = df.withColumn("before", F.lag("v", 1, "none").over(Window.partitionBy("k").orderBy("t", "seq")))
    sliced = skew.previous_value(
        df, "k", ["t", "seq"], "v", "none", "before", slices=7, policy=SkewPolicy(share=0.0, min_rows=50, fraction=1)
    )
    assert _rows(sliced) == _rows(plain)


@pytest.mark.parametrize("slices", [2, 7, 40])
def test_a_lag_over_slices_equals_one_window(spark, slices):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 1.0, 2.0, 3.0])) for i in range(60)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "i int, v double")
    want = df.withColumn("before", F.lag("v").over(Window.orderBy("i")))
    assert _rows(skew.sliced_lag(df, ["i"], "v", None, "before", slices)) == _rows(want)


def test_slices_follow_the_size_of_a_hot_key(spark, monkeypatch):
    asked = []
    sliced = skew.sliced_lag
    monkeypatch.setattr(skew, "sliced_lag", lambda *a: asked.append(a[5]) or sliced(*a))
    df = spark.range(4000).select(F.when(F.col("id") < 3000, "a").otherwise(F.col("id").cast("string")).alias("k"), "id")
    df = df.withColumn("v", F.col("id").cast("string"))
    policy = SkewPolicy(share=0.05, min_rows=1, fraction=1)
    found = skew.previous_value(df, "k", ["id"], "v", "-", "before", policy=policy)
    assert asked == [15]  # 3,000 rows in slices of 200
    want = df.withColumn("before", F.lag("v", 1, "-").over(Window.partitionBy("k").orderBy("id")))
    assert _rows(found) == _rows(want)


def test_many_runs_are_compared_in_slices(spark):
    rows = [(f"R{k:03}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=k // 2), float(k * 7 % 100)) for k in range(90)]
    runs = spark.createDataFrame(rows, "Run_ID string, Created_At timestamp_ntz, Match_Percentage double")
    plain, many = summarise.match_rate_change(runs), summarise.match_rate_change(runs, rows_per_task=20)
    assert plain.count() == 90 and _rows(plain) == _rows(many)
