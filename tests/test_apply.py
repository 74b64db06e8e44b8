import random

import pytest
from pyspark.sql import functions as F

from cdclake.operators.apply import _touched_folders, _within_range, apply_changes, apply_changes_partitioned, apply_to_table
from cdclake.operators.compact import compact_changes
from cdclake.sources import tables as tb
from tests.conftest import final_plan, plan_of
from tests.forms import replay

I, U, D = 1, 2, 3
TARGET = "id int, p string, v string"
CHANGES = "id int, p string, v string, operation int, seq bigint"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), TARGET)


def events(spark, *rows, ddl=CHANGES):
    return spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def lake(spark, tmp_path):
    def write(*rows, partition_by=""):
        path = str(tmp_path / "t")
        tb.write_table(table(spark, *rows), path, partition_by)
        return path

    return write


def test_insert_update_delete(spark, rows):
    target = table(spark, (1, "a", "x"), (2, "a", "y"), (3, "b", "z"))
    log = events(spark, (1, "a", "x2", U, 1), (2, "a", "y", D, 2), (4, "b", "new", I, 3), (5, "b", "never", D, 4))
    assert rows(apply_changes(target, log, "id")) == [(1, "a", "x2"), (3, "b", "z"), (4, "b", "new")]


def test_null_keys_and_duplicates(spark, rows):
    target = table(spark, (None, "a", "old"), (1, "a", "dup"), (1, "a", "dup"), (2, "a", "twice"), (2, "b", "twice"))
    deleted = events(spark, (None, "a", None, D, 1))
    assert apply_changes(target, deleted, "id").count() == 5
    written = events(spark, (None, "a", "new", U, 1), (2, "c", "once", U, 2))
    assert rows(apply_changes(target, written, "id")) == [(None, "a", "new"), (1, "a", "dup"), (1, "a", "dup"), (2, "c", "once")]


def test_columns_the_changes_lack_become_null_and_new_ones_arrive(spark, rows):
    target = table(spark, (1, "a", "x"), (2, "a", "y"))
    log = events(spark, (1, "a", 7, U, 1), ddl="ID int, P string, zz int, operation int, seq bigint")
    merged = apply_changes(target, log, "id")
    assert merged.columns == ["id", "p", "v", "zz"]
    assert rows(merged) == [(1, "a", None, 7), (2, "a", "y", None)]


def test_a_type_conflict_on_the_key_still_matches(spark, rows):
    target = table(spark, (1, "a", "x"), (2, "a", "y"))
    log = events(spark, ("1", "a", "z", U, 1), ddl="id string, p string, v string, operation int, seq bigint")
    assert rows(apply_changes(target, log, "id")) == [("1", "a", "z"), ("2", "a", "y")]


def test_load_stamp_is_managed_on_both_sides(spark, rows):
    log = events(spark, (1, "a", "x", U, 1)).withColumn("modified", F.lit("m2"))
    assert rows(apply_changes(table(spark, (2, "a", "y")), log, "id")) == [(1, "a", "x", "m2"), (2, "a", "y", None)]
    stamped = table(spark, (2, "a", "y")).withColumn("modified", F.lit("m1"))
    assert rows(apply_changes(stamped, log, "id")) == [(1, "a", "x", "m2"), (2, "a", "y", "m1")]


def random_changes(seed, n=300):
    r = random.Random(seed)
    state, log = set(range(10)), []
    for s in range(1, n + 1):
        k = r.choice([0, r.randrange(40), r.randrange(40)])
        op = (r.choice([U, U, D]) if k in state else I)
        state.add(k) if op != D else state.discard(k)
        log.append((k, f"p{r.randrange(4)}", f"v{s}", op, s))
    return [(i, "p0", "start") for i in range(10)], log


@pytest.mark.parametrize("mode", ["latest", "per_operation"])
def test_equals_replaying_the_log(spark, rows, mode):
    start, log = random_changes(5)
    expected = replay(
        {i: (i, p, v) for i, p, v in start},
        [{"id": k, "v": (k, p, v), "operation": op, "seq": s} for k, p, v, op, s in log],
    )
    merged = apply_changes(table(spark, *start), events(spark, *log), "id", compact=mode)
    assert sorted(map(str, rows(merged))) == sorted(map(str, expected.values()))


def test_repeating_and_slicing_change_nothing(spark, rows):
    start, log = random_changes(6)
    whole = apply_changes(table(spark, *start), events(spark, *log), "id")
    again = apply_changes(whole, events(spark, *log), "id")
    half = apply_changes(table(spark, *start), events(spark, *log[:150]), "id")
    sliced = apply_changes(half, events(spark, *log[150:]), "id")
    assert rows(again) == rows(whole) == rows(sliced)


def test_few_keys_are_broadcast_and_the_log_is_shuffled_once(spark, tmp_path):
    target, log = str(tmp_path / "t"), str(tmp_path / "log")
    table(spark, *[(i, "a", "x") for i in range(100)]).write.parquet(target)
    events(spark, *[(i, "a", "y", U, i) for i in range(10)]).write.parquet(log)
    plan = final_plan(apply_changes(spark.read.parquet(target), spark.read.parquet(log), "id"))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "ReusedExchange" in plan
    assert "Window" not in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


def test_apply_to_a_stored_table(spark, rows, lake):
    path = lake((1, "a", "x"), (2, "b", "y"))
    merged = apply_to_table(spark, path, events(spark, (1, "a", "z", U, 1), (2, "b", None, D, 2), (3, "c", "n", I, 3)), "id")
    assert rows(merged) == [(1, "a", "z"), (3, "c", "n")]
    assert rows(spark.read.parquet(path)) == rows(merged)


# --- partitioned tables ---

def files(spark, path):
    return {f.split("/t/")[1] for f in spark.read.parquet(path).inputFiles()}


def test_only_touched_partitions_are_written(spark, rows, lake):
    path = lake((1, "a", "x"), (2, "b", "y"), (3, "c", "z"), partition_by="p")
    before = files(spark, path)
    log = events(spark, (1, "a", "x2", U, 1), (4, "c", "n", I, 2))
    merged = apply_changes_partitioned(spark, path, log, "id", "p")
    assert rows(merged, "id", "p", "v") == [(1, "a", "x2"), (2, "b", "y"), (3, "c", "z"), (4, "c", "n")]
    after = files(spark, path)
    # Partition a was rewritten, c gained a file, b is as it was.
    assert {f for f in before if f[:3] in ("p=b", "p=c")} <= after
    assert not {f for f in before if f.startswith("p=a")} & after
    assert len([f for f in after if f.startswith("p=c")]) == 2


def test_a_row_that_moves_leaves_its_old_partition(spark, rows, lake):
    path = lake((1, "a", "x"), (2, "a", "y"), (3, "b", "z"), partition_by="p")
    merged = apply_changes_partitioned(spark, path, events(spark, (1, "b", "moved", U, 1)), "id", "p")
    assert rows(merged, "id", "p", "v") == [(1, "b", "moved"), (2, "a", "y"), (3, "b", "z")]


def test_an_emptied_partition_goes(spark, rows, lake):
    path = lake((1, "a", "x"), (2, "b", "y"), partition_by="p")
    merged = apply_changes_partitioned(spark, path, events(spark, (1, "a", None, D, 1)), "id", "p")
    assert rows(merged, "id", "p", "v") == [(2, "b", "y")]
    assert tb.partition_folders(spark, path, 1) == ["p=b"]


def test_a_table_can_be_emptied_and_filled_again(spark, rows, lake):
    path = lake((1, "a", "x"), partition_by="p")
    emptied = apply_changes_partitioned(spark, path, events(spark, (1, "a", None, D, 1)), "id", "p")
    assert rows(emptied) == []
    filled = apply_changes_partitioned(spark, path, events(spark, (2, "b", "y", I, 2)), "id", "p")
    assert rows(filled, "id", "p", "v") == [(2, "b", "y")]


def test_an_unpartitioned_table_can_be_emptied_and_filled_again(spark, rows, lake):
    path = lake((1, "a", "x"))
    assert rows(apply_to_table(spark, path, events(spark, (1, "a", None, D, 1)), "id")) == []
    assert rows(apply_to_table(spark, path, events(spark, (2, "b", "y", I, 2)), "id")) == [(2, "b", "y")]


def test_several_partition_columns_with_nulls_and_odd_names(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    ddl = "id int, p string, q int, v string"
    start = [(1, "a b", 1, "x"), (2, "c/d", 2, "y"), (3, None, None, "z"), (4, "a+b%", 1, "w")]
    tb.write_table(spark.createDataFrame(start, ddl), path, "p,q")
    log = events(
        spark, (1, "a b", 1, "x2", U, 1), (2, "e:f", 2, "y2", U, 2), (3, None, None, "z2", U, 3), (4, "a+b%", 1, None, D, 4),
        ddl="id int, p string, q int, v string, operation int, seq bigint",
    )
    merged = apply_changes_partitioned(spark, path, log, "id", ["p", "q"])
    assert rows(merged, "id", "p", "q", "v") == [(1, "a b", 1, "x2"), (2, "e:f", 2, "y2"), (3, None, None, "z2")]


def test_a_new_column_rewrites_the_table(spark, rows, lake):
    path = lake((1, "a", "x"), (2, "b", "y"), partition_by="p")
    log = events(spark, (1, "a", "x2", 7, U, 1), ddl="id int, p string, v string, zz int, operation int, seq bigint")
    apply_changes_partitioned(spark, path, log, "id", "p")
    assert rows(spark.read.parquet(path), "id", "p", "v", "zz") == [(1, "a", "x2", 7), (2, "b", "y", None)]


@pytest.mark.parametrize("seed", [7, 8])
def test_partitioned_equals_unpartitioned_and_repeats_safely(spark, rows, lake, seed):
    start, log = random_changes(seed)
    path = lake(*start, partition_by="p")
    for part in (log[:100], log[100:200], log[100:200], log[200:]):
        merged = apply_changes_partitioned(spark, path, events(spark, *part), "id", "p")
    expected = apply_changes(table(spark, *start), events(spark, *log), "id")
    assert rows(merged, "id", "p", "v") == rows(expected)
    assert rows(spark.read.parquet(path), "id", "p", "v") == rows(expected)


def test_partition_values_that_look_like_numbers_stay_text(spark, rows, lake):
    path = lake((1, "007", "x"), (2, "008", "y"), (3, "9", "z"), partition_by="p")
    merged = apply_changes_partitioned(spark, path, events(spark, (1, "007", "x2", U, 1), (3, "010", "z2", U, 2)), "id", "p")
    assert rows(merged, "id", "p", "v") == [(1, "007", "x2"), (2, "008", "y"), (3, "010", "z2")]
    assert tb.partition_folders(spark, path, 1) == ["p=007", "p=008", "p=010"]


def test_many_changed_keys_are_joined_by_shuffle(spark, rows, lake, monkeypatch):
    monkeypatch.setattr("cdclake.operators.apply.broadcast_if_small", lambda df: (df, False))
    path = lake((1, "a", "x"), (2, "b", "y"), (3, "b", "z"), partition_by="p")
    merged = apply_changes_partitioned(spark, path, events(spark, (1, "b", "x2", U, 1), (2, "b", None, D, 2)), "id", "p")
    assert rows(merged, "id", "p", "v") == [(1, "b", "x2"), (3, "b", "z")]


def test_null_keys_in_a_partitioned_table(spark, rows, lake):
    path = lake((None, "a", "x"), (1, "b", "y"), (9, "c", "z"), partition_by="p")
    log = [(None, "b", "n", U, 1), (1, "b", "y2", U, 2)]
    merged = apply_changes_partitioned(spark, path, events(spark, *log), "id", "p")
    assert rows(merged, "id", "p", "v") == [(None, "b", "n"), (1, "b", "y2"), (9, "c", "z")]
    deleted = events(spark, (None, "b", None, D, 3))
    assert rows(apply_changes_partitioned(spark, path, deleted, "id", "p"), "id", "p", "v") == rows(merged, "id", "p", "v")


def test_the_search_for_touched_partitions_is_pruned(spark, lake):
    path = lake(*[(i, "a", "x") for i in range(50)], partition_by="p")
    keys = spark.createDataFrame([(3,), (7,)], "id int")
    target = spark.read.parquet(path)
    plan = plan_of(target.where(_within_range(target, keys, ["id"])).select("id"))
    assert "GreaterThanOrEqual(id,3)" in plan and "LessThanOrEqual(id,7)" in plan and "ReadSchema: struct<id:int>" in plan
    assert _touched_folders(target, keys, ["id"], ["p"]) == ["p=a"]
    assert _touched_folders(target, keys.where("id > 7"), ["id"], ["p"]) == []


class Crash(Exception):
    pass


@pytest.mark.parametrize("partitioned,step", [(True, 0), (True, 2), (True, 3), (True, 5), (False, 0), (False, 1), (False, 2)])
def test_a_failure_while_publishing_loses_nothing(spark, rows, lake, monkeypatch, partitioned, step):
    start = [(1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (4, "d", "w")]
    path = lake(*start, partition_by="p" if partitioned else "")
    log = [(1, "b", "moved", U, 1), (3, "c", "z2", U, 2), (5, "d", "n", I, 3), (6, "e", "m", I, 4)]
    calls = {"n": 0}

    def failing(original):
        def call(*args):
            if calls["n"] == step:
                calls["n"] += 1
                raise Crash
            calls["n"] += 1
            return original(*args)

        return call

    def run():
        if partitioned:
            apply_changes_partitioned(spark, path, events(spark, *log), "id", "p")
        else:
            apply_to_table(spark, path, events(spark, *log), "id")

    with monkeypatch.context() as patch:
        patch.setattr(tb, "_move", failing(tb._move))
        patch.setattr(tb, "delete", failing(tb.delete))
        try:
            run()
        except Crash:
            pass
    tb.recover_table(spark, path)
    found = rows(spark.read.parquet(path), "id", "p", "v")
    expected = rows(apply_changes(table(spark, *start), events(spark, *log), "id"))
    assert found in (expected, start)
    run()
    assert rows(spark.read.parquet(path), "id", "p", "v") == expected


def test_a_hot_key_in_the_table(spark):
    target = spark.range(0, 3000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("int").alias("id"), F.lit("a").alias("p"), F.lit("x").alias("v")
    )
    log = events(spark, (-1, "a", "one", U, 1), (5, "a", None, D, 2))
    assert apply_changes(target, log, "id").count() == 2000 - 1 + 1
    assert compact_changes(log, "id").count() == 2
