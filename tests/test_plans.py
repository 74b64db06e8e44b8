"""Plans that must hold at scale: small joins stay off the shuffle, hot keys are split, scans are narrow."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from cdclake.model import Mapping, RUN_LOG
from cdclake.operators import apply as apply_module, consolidate as consolidate_module
from cdclake.operators.apply import apply_changes, apply_changes_partitioned, stage_delta
from cdclake.operators.consolidate import consolidate, map_columns, propagate_changes
from cdclake.operators.progress import latest_per_key, run_progress
from cdclake.plans.sizing import heaviest_key
from cdclake.sources.tables import write_table
from tests.conftest import final_plan, plan_of

MAPPING = [Mapping("key", ("a.l.id", "b.r.id"), unique=True)]


@contextmanager
def conf(spark, **settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# A test-sized stand-in for tables too large to broadcast, with partitions that count as skewed.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def hot(spark, tmp_path):
    """A stored frame in which one key owns a third of the rows."""

    def write(name, rows=30000, hot_key=7):
        path = str(tmp_path / name)
        spark.range(0, rows, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, F.lit(hot_key)).otherwise(F.col("id")).alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        ).write.parquet(path)
        return spark.read.parquet(path)

    return write


def test_a_hot_key_in_the_table_is_split_in_the_merge(spark, hot):
    changes = spark.range(20, 9000).select("id", F.lit("n").alias("v"), F.lit(2).alias("operation"), F.col("id").alias("seq"))
    with conf(spark, **LARGE):
        merged = apply_changes(hot("t"), changes, "id")
        assert "skew=true" in final_plan(merged)
        assert merged.where("id = 7").count() == 10001


def test_measured_keys_spare_the_table_the_shuffle(spark, hot, tmp_path):
    changes = spark.range(20, 900).select("id", F.lit("n").alias("v"), F.lit(2).alias("operation"), F.col("id").alias("seq"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        delta, _ = stage_delta(changes, "id")
        merged = apply_changes(hot("t"), delta, "id", compact=None, measure=True)
        assert "BroadcastHashJoin" in plan_of(merged) and "Exchange hashpartitioning" not in plan_of(merged)
        assert merged.where("v = 'n'").count() == 880


def test_a_hot_key_is_split_in_consolidation_on_either_side(spark, hot):
    small = spark.range(0, 3000).select("id", F.lit("s").alias("v"))
    for left, right in ((hot("l"), small), (small, hot("r"))):
        a, b = map_columns(left, MAPPING, "l", "a"), map_columns(right, MAPPING, "r", "b")
        with conf(spark, **LARGE):
            merged = consolidate(a, b, MAPPING)
            assert "skew=true" in final_plan(merged)
            assert merged.count() == consolidate(a, b, MAPPING, trust_unique=True).count()


@pytest.mark.parametrize("mode", ["replace", "patch"])
def test_a_hot_key_is_split_in_propagation(spark, hot, mode):
    merged = map_columns(hot("m"), MAPPING, "l", "a")
    changes = spark.range(20, 9000).select("id", F.lit("n").alias("v"), F.lit(2).alias("operation"), F.col("id").alias("seq"))
    with conf(spark, **LARGE):
        after = propagate_changes(merged, changes, MAPPING, "l", "a", mode=mode)
        assert "skew=true" in final_plan(after)
        assert after.where("key = 7").count() == 10001


def test_a_hot_key_with_ties_is_split_in_newest_rows(spark, hot):
    df = hot("t").withColumn("x", F.lit(1))
    with conf(spark, **LARGE):
        newest = latest_per_key(df, "id", "x")
        assert "skew=true" in final_plan(newest)
        assert newest.count() == 30000


def test_consolidation_with_a_small_member_does_not_shuffle_the_large_side_for_its_rows(spark, hot):
    a = map_columns(hot("l"), MAPPING, "l", "a")
    b = map_columns(spark.range(0, 30).select("id", F.lit("s").alias("v")), MAPPING, "r", "b")
    assert "SortMergeJoin FullOuter" not in plan_of(consolidate(a, b, MAPPING))
    assert plan_of(consolidate(a, b, MAPPING)).count("BroadcastHashJoin") >= 2


def test_a_measured_member_spares_the_consolidated_table_the_shuffle(spark, hot):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        a = map_columns(hot("l"), MAPPING, "l", "a")
        b = map_columns(spark.range(0, 30).select("id", F.lit("s").alias("v")), MAPPING, "r", "b")
        merged = consolidate(a, b, MAPPING, measure=True)
        # What is shuffled are the keys found on both sides, for the small side's own unmatched rows.
        exchanges = [line for line in plan_of(merged).split("\n") if "Exchange hashpartitioning" in line]
        assert len(exchanges) <= 2 and plan_of(merged).count("BroadcastHashJoin") == 3
        assert merged.count() == consolidate(a, b, MAPPING, trust_unique=True).count()


def test_the_plain_outer_join_is_used_only_without_heavy_keys(spark, hot, monkeypatch):
    a = map_columns(hot("l"), MAPPING, "l", "a")
    b = map_columns(spark.range(0, 3000).select("id", F.lit("s").alias("v")), MAPPING, "r", "b")
    monkeypatch.setattr(consolidate_module, "broadcast_if_small", lambda df: (df, False))
    expected = consolidate(a, b, MAPPING, trust_unique=True).count()
    light = consolidate(a, b, MAPPING, measure=True)
    assert "FullOuter" in plan_of(light)
    monkeypatch.setattr(consolidate_module, "HEAVY_KEY_ROWS", 10000)
    assert heaviest_key(a, ["key"]) == 10001
    for heavy in (consolidate(a, b, MAPPING, measure=True), consolidate(b, a, MAPPING, measure=True)):
        assert "FullOuter" not in plan_of(heavy)
        assert heavy.count() == expected == light.count()


def test_rewritten_partitions_are_not_shuffled(spark, hot, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "p"), []
    write_table(hot("t").withColumn("p", F.col("id") % 3), path, "p")
    write = apply_module.write_table
    monkeypatch.setattr(apply_module, "write_table", lambda df, *a, **k: (plans.append(plan_of(df)), write(df, *a, **k)))
    changes = spark.range(20, 40).select(
        "id", F.lit("n").alias("v"), (F.col("id") % 3).alias("p"), F.lit(2).alias("operation"), F.col("id").alias("seq")
    )
    merged = apply_changes_partitioned(spark, path, changes, "id", "p")
    assert merged.where("v = 'n'").count() == 20
    assert plans[0].count("Exchange hashpartitioning") == 1 and "REBALANCE_PARTITIONS_BY_COL" in plans[0]
    assert "BroadcastHashJoin" in plans[0]


def test_run_progress_is_two_hash_aggregates(spark):
    plan = plan_of(run_progress(spark.createDataFrame([], RUN_LOG).union(spark.createDataFrame([], RUN_LOG))))
    assert "SortAggregate" not in plan and "Window" not in plan
