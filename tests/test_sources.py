from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdclake.model import CHANGE
from cdclake.plans.sizing import broadcast_if_small
from cdclake.session import shared_dir, work_path
from cdclake.sources.jdbc import catalog_query, jdbc_url, read_jdbc, snapshot_table, stamp_load, stride_options
from cdclake.sources.log import read_changes, route_changes, union_changes
from cdclake.sources.tables import exists, list_names, replace_table, write_table
from tests.conftest import plan_of


def log(spark, *events):
    return spark.createDataFrame([(i, "h", "1", "db", t, None, "{}", 1, 0) for i, t in events], CHANGE)


def test_log_range_is_pushed_into_the_scan(spark, rows, tmp_path):
    path = str(tmp_path / "log")
    log(spark, *[(i, "a") for i in range(1, 6)]).write.parquet(path)
    events = read_changes(spark.read.parquet(path), 1, 3)
    assert rows(events, "id") == [(2,), (3,)]
    assert rows(read_changes(spark.read.parquet(path), 3), "id") == [(4,), (5,)]
    plan = plan_of(events)
    assert "GreaterThan(id,1)" in plan and "LessThanOrEqual(id,3)" in plan


def test_union_of_logs(spark, rows):
    a, b = log(spark, (1, "a"), (2, "a")), log(spark, (2, "a"), (3, "b")).withColumn("source", F.lit(None).cast("string"))
    assert rows(union_changes(a, b), "id", "source") == [(1, None), (2, None), (3, None)]


def test_routing_goes_by_each_events_own_columns(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    changes = log(spark, (1, "a"), (2, "B"), (3, "b"), (4, "a"))
    route_changes(changes, out, format="json")
    assert [n for n in list_names(spark, out) if "=" in n] == ["table_key=cdc-h-1-db-a", "table_key=cdc-h-1-db-b"]
    assert rows(spark.read.json(out + "/table_key=cdc-h-1-db-b"), "id", "table_name") == [(2, "B"), (3, "b")]


def test_partitioned_output_has_no_file_per_task(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 1000, numPartitions=20).select("id", (F.col("id") % 3).alias("p"))
    write_table(df, path, "p")
    assert len(spark.read.parquet(path).inputFiles()) <= 4


def test_a_large_partition_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 4)).alias("my part"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        write_table(df, path, "my part")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = [f for f in spark.read.parquet(path).inputFiles() if "part=hot" in f]
    assert len(hot) > 1 and spark.read.parquet(path).count() == 60000


def test_a_table_can_be_replaced_by_a_frame_that_reads_it(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).toDF("id"), path)
    replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert rows(spark.read.parquet(path)) == [(3,), (4,)]
    assert list_names(spark, str(tmp_path)) == ["t"]
    assert not exists(spark, path + "/_publish.json")


def test_a_failing_replacement_leaves_the_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).toDF("id"), path)
    broken = spark.read.parquet(path).select(F.expr("cast(if(id > 2, 'x', '1') as int)").alias("id"))
    with pytest.raises(Exception):
        replace_table(broken, path)
    assert spark.read.parquet(path).count() == 5


def test_snapshot(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([(1, "007"), (2, "8")], "id int, code string")
    copy = snapshot_table(spark, source, path, "code", modified="2024-01-01 00:00:00.000")
    # Partition values keep their type: "007" stays text.
    assert rows(copy, "id", "code", "modified") == [(1, "007", "2024-01-01 00:00:00.000"), (2, "8", "2024-01-01 00:00:00.000")]
    assert rows(snapshot_table(spark, source.where("id = 2"), path, " ", modified="m"), "id") == [(2,)]
    stamp = stamp_load(source).first()["modified"]
    assert len(stamp) == len("2024-01-01 00:00:00.000")


def test_jdbc_options():
    assert jdbc_url("postgresql", "h", 5432, "db") == "jdbc:postgresql://h:5432/db"
    assert jdbc_url("oracle", "h", 1521, "sid") == "jdbc:oracle:thin:@h:1521:sid"
    with pytest.raises(ValueError):
        jdbc_url("db2", "h", 1, "d")
    assert stride_options("id", 1, 100, 8) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    assert stride_options("id", None, None, 8) == {}
    decimals = stride_options("id", Decimal("5.0000000000"), Decimal("9.5"), None)
    assert (decimals["lowerBound"], decimals["upperBound"]) == ("5", "9")


class RecordingReader:
    """Stands in for a session's reader: records what each load asks for."""

    def __init__(self, bounds):
        self.bounds, self.loads, self.asked = bounds, [], {}
        self.read = self

    def format(self, name):
        self.asked = {"format": name}
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def load(self):
        self.loads.append(self.asked)
        return self

    def first(self):
        return self.bounds


def test_a_source_table_is_read_in_strides_over_its_own_bounds():
    options = {"url": "jdbc:mysql://h:1/d", "dbtable": "orders", "user": "u"}
    reader = RecordingReader((5, 900))
    read_jdbc(reader, options, partition_column="id", num_partitions=4)
    bounds, scan = reader.loads
    assert bounds["query"] == "select min(id) lo, max(id) hi from orders" and "dbtable" not in bounds
    assert scan == {
        "format": "jdbc", **options, "partitionColumn": "id", "lowerBound": "5", "upperBound": "900", "numPartitions": "4",
    }
    whole = RecordingReader(None)
    read_jdbc(whole, options)
    assert whole.loads == [{"format": "jdbc", **options}]


def test_catalog_queries():
    for system in ("mysql", "postgresql", "oracle"):
        sql = catalog_query(system, "shop")
        assert all(c in sql for c in ("table_name", "column_name", "ordinal_position", "data_type", "column_default"))
    assert "table_schema = 'shop'" in catalog_query("mysql", "shop")
    with pytest.raises(ValueError):
        catalog_query("mysql", "x' or '1")


def test_broadcast_only_what_was_measured_to_be_small(spark):
    def hinted(*args, **limits):
        df, small = broadcast_if_small(*args, **limits)
        assert small == ("ResolvedHint" in df._jdf.queryExecution().analyzed().toString())
        return small

    numbers = spark.range(100)
    assert hinted(numbers) and not hinted(numbers, max_rows=99)
    text = numbers.select(F.repeat(F.lit("x"), 100).alias("t"))
    assert hinted(text) and not hinted(text, max_bytes=9999)


def test_the_work_folder_is_the_one_the_session_names(spark):
    assert work_path(spark, "x").startswith(shared_dir(spark) + "/cdclake/x-")
    assert work_path(spark, "x") != work_path(spark, "x")
