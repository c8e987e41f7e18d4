import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfprice.plans import staging
from shelfprice.plans.joins import attach_groups, is_small
from shelfprice.plans.quantiles import exact_quantiles
from shelfprice.plans.topk import first_per_group, top
from tests.conftest import values


def test_quantiles_match_numpy_on_skewed_groups(spark):
    rng = random.Random(5)
    groups = {
        "hot": [round(rng.lognormvariate(4, 2), 2) for _ in range(5000)] + [99.5] * 3000,
        "few": [1.0, 2.0, 7.5, 100.0, 31.25, 9.9],
        "one": [3.25],
        "wide": [-2500.5, -1.0, 0.0, 999.99, 1000.0, 99999999.99],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("none", None), ("few", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    probs = {"a": 0.25, "m": 0.5, "z": 0.99, "lo": 0.0, "hi": 1.0}
    found = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    assert set(found) == set(groups)
    for k, vs in groups.items():
        for name, p in probs.items():
            assert found[k][name] == pytest.approx(np.quantile(vs, p), abs=1e-6), (k, name)
    assert exact_quantiles(df.where("k='few'"), [], "v", {"z": 0.99}).collect()[0][0] == 96.5625


def test_hazen_quantiles(spark):
    vs = [float(x) for x in (1, 5, 2, 9, 4, 4, 7)]
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    found = exact_quantiles(df, [], "v", {"q1": 0.25, "q3": 0.75, "lo": 0.0, "hi": 1.0}, "hazen").first()
    expected = [np.quantile(vs, p, method="hazen") for p in (0.25, 0.75, 0.0, 1.0)]
    assert list(found) == pytest.approx(expected, abs=1e-6)


def test_quantile_plan_never_collects_a_group(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    plan = exact_quantiles(df, ["k"], "v", {"p": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture
def no_auto_broadcast(spark):
    """Small test tables would be broadcast by their file size alone."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("limit", [10_000, 0])
def test_attach_groups_same_rows_on_both_strategies(spark, limit, no_auto_broadcast):
    rows = [("hot", i) for i in range(9000)] + [(f"g{i}", i) for i in range(3000)] + [(None, -i) for i in range(99)]
    rows += [("lost", i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int")
    groups = df.where("k <> 'lost'").groupBy("k").agg(F.max("v").alias("m"))
    left = attach_groups(df, groups, ["k"], max_broadcast_rows=limit)
    assert left.count() == len(rows)
    best = {"hot": 8999, **{f"g{i}": i for i in range(3000)}}
    assert all(r["m"] == best.get(r["k"]) for r in left.collect())
    assert attach_groups(df, groups, ["k"], "inner", limit).count() == 12000
    assert left.columns == ["k", "v", "m"]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and ("SortMergeJoin" in plan) == (limit == 0)


def test_small_means_few_rows_and_few_bytes(spark):
    df = spark.createDataFrame([("é" * 10, 1), (None, 2)], "k string, v int")
    assert is_small(df, 2, 20) and not is_small(df, 1, 20) and not is_small(df, 2, 19)
    assert is_small(df.limit(0), 0, 0) and is_small(df.select("v"), 2, 0)


@pytest.mark.parametrize("key", ["hot", None])
def test_hot_and_missing_keys_are_split(spark, no_auto_broadcast, key):
    df = spark.range(4000).select(F.lit(key).cast("string").alias("k"), F.col("id").alias("v"))
    joined = attach_groups(df, df.groupBy("k").agg(F.count("v").alias("n")), ["k"], max_broadcast_rows=0)
    sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000


def test_first_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    first = first_per_group(df, [F.col("k")], F.col("id"))
    assert values(first) == [(0, 0), (1, 1), (2, 2)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("WindowGroupLimit") == 2


def test_top_is_not_a_full_sort(spark):
    plan = top(spark.range(100), 3, F.desc("id"))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_stage_writes_below_the_shared_folder(spark):
    staged = staging.stage(spark.range(10).toDF("x"), "numbers")
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
    assert values(staged) == [(i,) for i in range(10)]


def test_staged_block_cleans_up(spark):
    with staging.staged(spark.range(3).toDF("x"), "numbers") as df:
        assert df.count() == 3
        folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
