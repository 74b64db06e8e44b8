import random

import pytest
from pyspark.sql import functions as F

from cdclake.operators.compact import compact_changes
from tests.conftest import plan_of
from tests.forms import literal_compaction

I, U, D = 1, 2, 3


def events(spark, *items):
    return spark.createDataFrame([(k, f"v{s}", op, s) for k, op, s in items], "id int, v string, operation int, seq bigint")


@pytest.mark.parametrize("items,kept", [
    ([(1, I, 1), (1, U, 2)], [2]),
    ([(1, I, 1), (1, D, 2)], [2]),
    ([(1, I, 1), (1, D, 2), (1, I, 3)], [2, 3]),
    ([(1, U, 1), (1, U, 2)], [2]),
    ([(1, D, 1)], [1]),
    ([(1, D, 1), (1, D, 2)], [2]),
    ([(1, U, 1), (1, I, 2)], [1, 2]),
    ([(1, D, 1), (1, U, 2), (1, D, 3), (1, U, 4), (1, U, 5)], [3, 5]),
    ([(None, I, 1), (None, U, 2), (None, D, 3), (None, I, 4)], [2, 3, 4]),
    ([(1, I, 1), (2, D, 2)], [1, 2]),
])
def test_per_operation_rules(spark, items, kept):
    found = compact_changes(events(spark, *items), "id")
    assert sorted(r["seq"] for r in found.collect()) == kept


def random_log(seed, n=4000):
    r = random.Random(seed)
    # One key holds a third of the events, and some have none.
    keys = [0] * (n // 3) + [None] * (n // 20) + [r.randrange(1, 60) for _ in range(n)]
    return [(k, r.choice([I, U, U, D]), s) for s, k in enumerate(r.sample(keys, n))]


@pytest.mark.parametrize("seed", [1, 2])
def test_per_operation_equals_its_definition(spark, rows, seed):
    log = events(spark, *random_log(seed)).repartition(7)
    assert rows(compact_changes(log, "id")) == rows(literal_compaction(log, "id"))


def test_latest_keeps_one_row_per_key(spark, rows):
    log = random_log(3)
    newest = {}
    for k, op, s in log:
        newest[k] = (k, f"v{s}", op, s)
    found = compact_changes(events(spark, *log), "id", mode="latest")
    assert rows(found) == sorted(newest.values(), key=lambda r: [(v is not None, str(v)) for v in r])


def test_composite_keys_and_column_order(spark, rows):
    df = spark.createDataFrame([(1, "a", 1, 9, 1), (2, "a", 1, 9, 2), (3, "a", 2, 9, 1), (4, None, 1, 9, 1)],
                               "seq bigint, a string, b int, v int, operation int")
    found = compact_changes(df, ["a", "b"], mode="latest")
    assert found.columns == df.columns
    assert [r[0] for r in rows(found)] == [2, 3, 4]


def test_replayed_events_count_once(spark):
    log = events(spark, (1, I, 1), (1, I, 1), (1, U, 2), (1, U, 2))
    assert compact_changes(log, "id").count() == 1


@pytest.mark.parametrize("mode", ["latest", "per_operation"])
def test_one_shuffle_after_a_partial_aggregate(spark, mode):
    plan = plan_of(compact_changes(events(spark, (1, I, 1)), "id", mode=mode))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in plan
    assert "Window" not in plan


def test_a_hot_key_leaves_each_map_task_as_one_row(spark):
    hot = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(2).alias("operation"), F.col("id").alias("seq")
    )
    found = compact_changes(hot, "k", mode="latest")
    assert found.count() == 20001 and found.where("k = 0").first()["seq"] == 29997


def test_a_key_is_needed(spark):
    with pytest.raises(ValueError):
        compact_changes(events(spark, (1, I, 1)), "")
    with pytest.raises(ValueError):
        compact_changes(events(spark, (1, I, 1)), "nope")
