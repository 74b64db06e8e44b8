from pyspark.sql import functions as F

from cdclake.model import CHANGE, RUN_LOG
from cdclake.operators.progress import (
    append_run_log, cdc_lag, change_watermarks, latest_per_key, run_event, run_progress,
)
from tests.conftest import plan_of


def log(spark, *events):
    return spark.createDataFrame([(i, "h", "1", "db", t, None, None, 1, 0) for i, t in events], CHANGE)


def test_watermarks_and_lag(spark, rows):
    changes = log(spark, (1, "a"), (5, "A"), (3, "b"), (4, "c"))
    assert rows(change_watermarks(changes)) == [("cdc-h-1-db-a", 5, 2), ("cdc-h-1-db-b", 3, 1), ("cdc-h-1-db-c", 4, 1)]
    assert rows(change_watermarks(changes, by="server")) == [("h", "1", 5, 4)]
    applied = spark.createDataFrame([("cdc-h-1-db-a", 2), ("cdc-h-1-db-a", 4), ("cdc-h-1-db-b", 3)], "table_key string, last_id bigint")
    assert rows(cdc_lag(changes, applied)) == [
        ("cdc-h-1-db-a", 5, 4, 1, True), ("cdc-h-1-db-b", 3, 3, 0, False), ("cdc-h-1-db-c", 4, 0, 4, True),
    ]


def test_newest_rows_keep_ties_nulls_and_null_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, "a", 1), (1, 5, "a", 2), (1, 5, None, 3), (1, 4, "z", 4), (None, 1, "a", 5), (None, 2, None, 6), (2, None, None, 7)],
        "k int, x int, y string, id int",
    )
    assert [r[3] for r in sorted(latest_per_key(df, "k", ["x", "y"]).collect(), key=lambda r: r["id"])] == [1, 2, 6, 7]


def test_newest_rows_of_a_hot_key_need_no_window(spark):
    df = spark.range(3000).select((F.col("id") % 3 * F.col("id")).alias("k"), F.lit(1).alias("x"), "id")
    found = latest_per_key(df, "k", "x")
    assert found.count() == df.count()
    assert "Window" not in plan_of(found)


def test_run_log(spark, rows, tmp_path):
    path = str(tmp_path / "runs")
    first = [
        run_event(1, "processing", "read", job_id=1, number_step=3, create_time="2024/01/01 00:00:00.000"),
        run_event(1, "success", "read", job_id=1, number_step=3, create_time="2024/01/01 00:00:00.000"),
        run_event(2, "processing", "merge", job_id=1, number_step=3, create_time="2024/01/01 00:00:01.000"),
    ]
    second = [
        run_event(2, "fail", "merge", job_id=1, number_step=3, create_time="2024/01/01 00:00:02.000"),
        run_event(1, "processing", "read", job_id=2, number_step=3, create_time="2024/01/01 00:00:02.000"),
    ]
    append_run_log(spark.createDataFrame(first, RUN_LOG), path)
    append_run_log(spark.createDataFrame(second, RUN_LOG).drop("statusOrder"), path)
    stored = spark.read.parquet(path)
    assert rows(stored, "statusOrder") == [(1,), (1,), (1,), (2,), (3,)]
    assert rows(run_progress(stored)) == [(1, 3, 1, 1, 0, "fail"), (2, 3, 0, 0, 1, "processing")]
