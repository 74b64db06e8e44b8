import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from cdclake.model import CHANGE, Mapping, RUN_LOG
from cdclake.operators.consolidate import map_columns
from cdclake.operators.progress import append_run_log, run_event, run_progress
from cdclake.sources.tables import write_table
from cdclake.sources.versions import read_table
from cdclake.streaming.stream import (
    ApplyRegistry, ChangeApplier, MergeTarget, QueryRunner, TableMerger, TableTarget, read_stream, stream_changes, stream_run_log,
)

I, U, D = 1, 2, 3
MAPPING = [Mapping("key", ("crm.t.id", "erp.u.id"), unique=True)]


@pytest.fixture
def lake(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, v string"), f"{base}/t")
    write_table(map_columns(spark.read.parquet(f"{base}/t"), MAPPING, "t", "crm"), f"{base}/party")
    return base


def emit(spark, base, *events):
    """Append events ``(id, table, operation, image)`` to the log folder."""
    spark.createDataFrame(
        [(i, "h", "1", "db", t, '["id:bigint","v:varchar(9)"]', v, op, 0) for i, t, op, v in events], CHANGE
    ).coalesce(1).write.mode("append").json(f"{base}/log")


def applier(spark, base, **options):
    target = TableTarget(f"{base}/t", "id", "t", merges=[MergeTarget(f"{base}/party", MAPPING, "crm")], **options)
    return ChangeApplier(spark, {"cdc-h-1-db-t": target}, f"{base}/applied", f"{base}/bad", f"{base}/runs", compact_state_every=1)


def run(spark, base, handler):
    stream_changes(spark, f"{base}/log", handler, f"{base}/checkpoint", once=True, maxFilesPerTrigger="1").awaitTermination()


def test_stream_applies_propagates_and_restarts(spark, rows, lake):
    handler = applier(spark, lake)
    emit(spark, lake, (1, "t", U, '{"id":"1","v":"x2"}'), (2, "other", I, '{"id":"9","v":"n"}'))
    run(spark, lake, handler)
    emit(spark, lake, (3, "T", D, '{"id":"2","v":"y"}'), (4, "t", I, '{"id":"3","v":"z"}'), (5, "t", I, "{broken"))
    run(spark, lake, applier(spark, lake))
    assert rows(spark.read.parquet(f"{lake}/t")) == [(1, "x2"), (3, "z")]
    assert rows(spark.read.parquet(f"{lake}/party"), "key", "v_t_crm") == [(1, "x2"), (3, "z")]
    assert rows(handler.applied(), "table_key", "last_id") == [("cdc-h-1-db-t", 5)]
    assert rows(spark.read.parquet(f"{lake}/bad"), "id", "reason", "table_key") == [
        (2, "unregistered table", "cdc-h-1-db-other"), (5, "broken row image", "cdc-h-1-db-t"),
    ]
    assert rows(run_progress(spark.read.parquet(f"{lake}/runs"))) == [(0, 4, 4, 0, 0, "success"), (1, 4, 4, 0, 0, "success")]


def test_a_replayed_batch_changes_nothing(spark, rows, lake):
    handler = applier(spark, lake)
    emit(spark, lake, (1, "t", U, '{"id":"1","v":"x2"}'), (2, "t", D, '{"id":"2","v":"y"}'), (3, "t", I, '{"id":"4","v":"w"}'))
    batch = spark.read.schema(CHANGE).json(f"{lake}/log")
    handler(batch, 0)
    once = rows(spark.read.parquet(f"{lake}/t"))
    handler(batch, 0)
    handler(batch.where("id < 3"), 1)
    assert rows(spark.read.parquet(f"{lake}/t")) == once == [(1, "x2"), (4, "w")]


def test_late_events_are_set_aside(spark, rows, lake):
    emit(spark, lake, (9, "t", U, '{"id":"1","v":"late"}'), (10, "t", U, '{"id":"1","v":"x10"}'), (11, "t", U, '{"id":"2","v":"y11"}'))
    handler = applier(spark, lake)
    events = spark.read.schema(CHANGE).json(f"{lake}/log")
    handler(events.where("id = 10"), 0)
    handler(events.where("id <> 10"), 1)
    assert rows(spark.read.parquet(f"{lake}/t")) == [(1, "x10"), (2, "y11")]
    late = spark.read.parquet(f"{lake}/bad")
    assert rows(late, "id", "reason", "table_key") == [(9, "behind applied position", "cdc-h-1-db-t")]


def test_a_failed_batch_runs_again(spark, rows, lake):
    emit(spark, lake, (1, "t", U, '{"id":"1","v":"x2"}'))
    handler = applier(spark, lake)

    def fails_after_the_merge(batch, batch_id):
        handler(batch, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        run(spark, lake, fails_after_the_merge)
    run(spark, lake, handler)
    assert rows(spark.read.parquet(f"{lake}/t")) == [(1, "x2"), (2, "y")]


def unreadable(path):
    """A folder whose only Parquet file is none."""
    os.makedirs(path)
    with open(f"{path}/part.parquet", "w") as out:
        out.write("not Parquet")
    return path


def test_a_failing_step_is_noted(spark, lake):
    handler = applier(spark, lake)
    handler.targets["cdc-h-1-db-t"].merges[0].path = unreadable(f"{lake}/broken")
    emit(spark, lake, (1, "t", U, '{"id":"1","v":"x2"}'))
    with pytest.raises(Exception):
        handler(spark.read.schema(CHANGE).json(f"{lake}/log"), 0)
    assert run_progress(spark.read.parquet(f"{lake}/runs")).first()["last_status"] == "fail"
    assert handler.applied().count() == 0


def test_several_tables_side_by_side(spark, rows, tmp_path):
    base, targets = str(tmp_path), {}
    mapping = [Mapping("key", tuple(f"crm.t{i}.id" for i in range(5)), unique=True)]
    for i in range(5):
        write_table(spark.createDataFrame([(1, "x")], "id bigint, v string"), f"{base}/t{i}")
        # The first three feed one consolidated table.
        merges = [MergeTarget(f"{base}/party", mapping, "crm", mode="patch")] if i < 3 else []
        targets[f"cdc-h-1-db-t{i}"] = TableTarget(f"{base}/t{i}", "id", f"t{i}", merges=merges)
    write_table(spark.createDataFrame([(1,)], "key bigint"), f"{base}/party")
    handler = ChangeApplier(spark, targets, f"{base}/applied", f"{base}/bad", f"{base}/runs", parallel=3)
    assert [len(t) for t in handler._turns(targets)] == [3, 1, 1]
    targets["cdc-h-1-db-t4"].path = unreadable(f"{base}/broken")
    emit(spark, base, *[(i + 1, f"t{i}", U, json.dumps({"id": "1", "v": f"n{i}"})) for i in range(5)])
    batch = spark.read.schema(CHANGE).json(f"{base}/log")
    with pytest.raises(Exception):
        handler(batch, 0)
    # The failing table alone is left to do.
    assert rows(handler.applied(), "table_key", "last_id") == [(f"cdc-h-1-db-t{i}", i + 1) for i in range(4)]
    targets["cdc-h-1-db-t4"].path = f"{base}/t4"
    handler(batch, 0)
    assert [rows(spark.read.parquet(f"{base}/t{i}"), "v") for i in range(5)] == [[(f"n{i}",)] for i in range(5)]
    assert rows(spark.read.parquet(f"{base}/party"), "v_t0_crm", "v_t1_crm", "v_t2_crm") == [("n0", "n1", "n2")]


def message_folder(spark, base, *requests):
    spark.createDataFrame([(json.dumps(r),) for r in requests], "value string").coalesce(1).write.mode("append").parquet(f"{base}/requests")
    return read_stream(spark, f"{base}/requests", "parquet", T.StructType([T.StructField("value", T.StringType())]))


def test_query_requests(spark, rows, lake):
    source = message_folder(
        spark, lake, {"jobId": 1, "requestId": 2, "etlID": 3, "query": "select * from :crm.t:"}, {"jobId": 2, "requestId": 2, "etlID": 3, "query": "?"},
    )
    runner = QueryRunner(spark, {"crm.t": f"{lake}/t"}, f"{lake}/results", f"{lake}/outcomes")
    stream_changes(spark, source, runner, f"{lake}/checkpoint", once=True).awaitTermination()
    assert rows(spark.read.parquet(f"{lake}/outcomes"), "jobId", "status", "total_rows") == [(1, "success", 2), (2, "fail", None)]


def test_merge_requests(spark, rows, tmp_path):
    base = str(tmp_path)
    mapping = [Mapping("key", ("crm.t.id", "erp.u.id"), unique=True)]
    for host, name, start in (("h1", "t", 0), ("h2", "u", 1)):
        write_table(spark.range(start, start + 2).select("id", F.lit(name).alias("v")), f"{base}/mysql/{host}/1/db/{name}")
    merger = TableMerger(spark, {"party": mapping}, lambda host, port: {"h1": "crm", "h2": "erp"}[host], base)
    for host, name in (("h1", "t"), ("h2", "u"), ("h2", "u")):
        source = message_folder(spark, base, {"host": host, "port": "1", "table": name, "databaseType": "mysql", "database": "db", "mergeTable": "party"})
        stream_changes(spark, source, merger, f"{base}/checkpoint", once=True).awaitTermination()
    assert rows(spark.read.parquet(f"{base}/merge_request/party"), "key", "v_t_crm", "v_u_erp") == [(0, "t", None), (1, "t", "u"), (2, None, "u")]


def test_run_log_stream(spark, rows, tmp_path):
    base = str(tmp_path)
    append_run_log(spark.createDataFrame([run_event(1, "success", "m", job_id=4)], RUN_LOG), f"{base}/in")
    stream_run_log(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", once=True).awaitTermination()
    assert rows(spark.read.parquet(f"{base}/out"), "job_id", "status", "statusOrder") == [(4, "success", 3)]


def test_partitioned_target(spark, rows, tmp_path):
    base = str(tmp_path)
    write_table(spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, v string"), f"{base}/t", "v")
    handler = ChangeApplier(
        spark, {"cdc-h-1-db-t": TableTarget(f"{base}/t", "id", "t", partition_by="v")}, f"{base}/applied", f"{base}/bad"
    )
    emit(spark, base, (1, "t", U, '{"id":"1","v":"y"}'))
    run(spark, base, handler)
    assert rows(spark.read.parquet(f"{base}/t"), "id", "v") == [(1, "y"), (2, "y")]


def test_late_events_whatever_the_batch_number(spark, rows, lake):
    """A new checkpoint numbers its batches anew; what is late is told by position, not by number."""
    emit(spark, lake, *[(i, "t", U, json.dumps({"id": "1", "v": f"x{i}"})) for i in (10, 20, 30, 40, 15)])
    events, handler = spark.read.schema(CHANGE).json(f"{lake}/log"), applier(spark, lake)
    handler(events.where("id in (10, 20)"), 3)
    handler(events.where("id in (30, 40)"), 0)
    for _ in range(2):
        handler(events.where("id in (15, 40)"), 3)
    assert rows(spark.read.parquet(f"{lake}/bad"), "id", "reason") == [(15, "behind applied position")]
    assert rows(spark.read.parquet(f"{lake}/t")) == [(1, "x40"), (2, "y")]
    assert rows(handler.applied(), "last_id") == [(40,)]


def test_positions_are_not_gathered_in_one_task(spark, rows, lake):
    """Neither those applied nor those set aside: written by one task, a file each, they also were joined by one."""
    emit(spark, lake, *[(i, "t", U, json.dumps({"id": "1", "v": f"x{i}"})) for i in range(1, 401)])
    events, handler = spark.read.schema(CHANGE).json(f"{lake}/log"), applier(spark, lake)
    handler.compact_state_every = 100
    few = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64b", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    for name, value in few.items():
        spark.conf.set(name, value)
    try:
        counts = []
        for number, part in enumerate(["id > 300 or id % 2 = 0", "id <= 300 and id % 2 = 1"]):
            handler(events.where(part), number)
            counts.append(len([f for f in os.listdir(handler.positions) if f.startswith("part-")]))
    finally:
        for name in few:
            spark.conf.unset(name)
    assert counts[0] > 1 and counts[1] - counts[0] > 1
    assert rows(spark.read.parquet(handler.positions).select("id").distinct()) == sorted(((i,) for i in range(1, 401)), key=str)
    assert spark.read.parquet(f"{lake}/bad").count() == 150


def test_a_table_that_keeps_failing_is_set_aside(spark, rows, tmp_path):
    base = str(tmp_path)
    write_table(spark.createDataFrame([(1, "x")], "id bigint, v string"), f"{base}/t")
    targets = {"cdc-h-1-db-t": TableTarget(f"{base}/t", "id", "t"), "cdc-h-1-db-u": TableTarget(unreadable(f"{base}/u"), "id", "u")}
    handler = ChangeApplier(spark, targets, f"{base}/applied", f"{base}/bad", f"{base}/runs", max_retries=2)
    emit(spark, base, *[(i, "tu"[i % 2], U, json.dumps({"id": "1", "v": f"n{i}"})) for i in range(1, 7)])
    events = spark.read.schema(CHANGE).json(f"{base}/log")
    with pytest.raises(Exception):
        handler(events.where("id <= 2"), 0)
    assert handler._failed(list(targets)) == {"cdc-h-1-db-t": 0, "cdc-h-1-db-u": 1}
    handler(events.where("id <= 2"), 0)
    handler(events.where("id in (3, 4)"), 1)
    assert rows(spark.read.parquet(f"{base}/t"), "v") == [("n4",)]
    assert rows(spark.read.parquet(f"{base}/bad"), "id", "reason") == [(1, "table set aside"), (3, "table set aside")]
    statuses = spark.read.parquet(f"{base}/runs").select("table_name", "status").distinct()
    assert ("t", "success") in rows(statuses) and ("u", "fail") in rows(statuses)
    targets["cdc-h-1-db-u"].path = f"{base}/u2"
    handler.resume("cdc-h-1-db-u")
    handler(events.where("id >= 5"), 2)
    assert rows(spark.read.parquet(f"{base}/u2"), "id", "v") == [(1, "n5")]
    assert rows(handler.applied(), "table_key", "last_id") == [("cdc-h-1-db-t", 6), ("cdc-h-1-db-u", 5)]


@pytest.mark.parametrize("mode", ["replace", "patch"])
def test_targets_kept_as_versions(spark, rows, tmp_path, mode):
    """Copy and consolidated table start from the stream, and a unique value that changes leaves no row."""
    base = str(tmp_path)
    mapping = [Mapping("name", ("crm.t.v",), unique=True)]
    merge = MergeTarget(f"{base}/party", mapping, "crm", mode, versioned=True)
    target = TableTarget(f"{base}/t", "id", "t", merges=[merge], versioned=True)
    handler = ChangeApplier(spark, {"cdc-h-1-db-t": target}, f"{base}/applied", f"{base}/bad")
    emit(spark, base, (1, "t", I, '{"id":"1","v":"a"}'), (2, "t", I, '{"id":"2","v":"b"}'))
    run(spark, base, handler)
    emit(spark, base, (3, "t", U, '{"id":"1","v":"c"}'))
    run(spark, base, handler)
    assert rows(read_table(spark, f"{base}/t"), "id", "v") == [(1, "c"), (2, "b")]
    assert rows(read_table(spark, f"{base}/party"), "name", "id_t_crm") == [("b", 2), ("c", 1)]


def test_a_plain_consolidated_table_is_started(spark, rows, tmp_path):
    base = str(tmp_path)
    merge = MergeTarget(f"{base}/party", MAPPING, "crm", partition_by="v_t_crm")
    handler = ChangeApplier(
        spark, {"cdc-h-1-db-t": TableTarget(f"{base}/t", "id", "t", merges=[merge])}, f"{base}/applied", f"{base}/bad"
    )
    emit(spark, base, (1, "t", I, '{"id":"1","v":"a"}'), (2, "t", I, '{"id":"2","v":"b"}'))
    run(spark, base, handler)
    assert rows(spark.read.parquet(f"{base}/party"), "key", "v_t_crm") == [(1, "a"), (2, "b")]


def request(**fields):
    whole = {
        "server_host": "h", "port": "1", "database": "db", "table": "t", "database_type": "MySQL", "identity_key": "id",
        "latest_offset": 2, "job_id": 1,
    }
    return json.dumps({k: v for k, v in {**whole, **fields}.items() if v is not None})


def requests(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_the_newest_request_of_a_table_counts(spark, rows, tmp_path):
    registry = ApplyRegistry(spark, f"{tmp_path}/registry", "/lake", lambda ref: [MergeTarget("/m", MAPPING, ref.host)])
    assert registry() == {}
    first = requests(spark, request(), request(), request(job_id=2, max_retries=3), request(table="U", partition_by="v"))
    registry(first, 0)
    registry(first, 0)
    registry(requests(spark, request(table="U", latest_offset=9, job_id=0), request(identity_key=" "), request(table=None), "{", None), 1)
    assert registry() == {
        "cdc-h-1-db-t": TableTarget("/lake/mysql/h/1/db/t", "id", "t", "mysql", "", [MergeTarget("/m", MAPPING, "h")], False, 2, 3),
        "cdc-h-1-db-u": TableTarget("/lake/mysql/h/1/db/U", "id", "U", "mysql", "", [MergeTarget("/m", MAPPING, "h")], False, 9, None),
    }
    assert rows(registry.requests().where("not valid"), "reason") == [("no identity_key",), ("no server_host",), ("no table",)]


def test_a_table_registered_late_gets_its_earlier_events(spark, rows, tmp_path):
    base = str(tmp_path)
    path = f"{base}/mysql/h/1/db/t"
    write_table(spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, v string"), path)
    registry = ApplyRegistry(spark, f"{base}/registry", base)
    handler = ChangeApplier(spark, registry, f"{base}/applied", f"{base}/bad")

    def events(*found):
        return spark.createDataFrame(
            [(i, "h", "1", "db", t, '["id:bigint","v:varchar(9)"]', v, op, 0) for i, t, op, v in found], CHANGE
        )

    early = events((1, "t", U, '{"id":"1","v":"in the snapshot"}'), (3, "t", U, '{"id":"1","v":"x3"}'), (4, "o", I, '{"id":"1"}'))
    handler(early, 0)
    assert rows(spark.read.parquet(path)) == [(1, "x"), (2, "y")]
    registry(requests(spark, request()), 0)
    handler(events((5, "o", I, '{"id":"2"}')), 1)  # a batch without an event of the table will do
    assert rows(spark.read.parquet(path)) == [(1, "x3"), (2, "y")]
    handler(events((6, "t", D, '{"id":"2"}')), 2)
    handler(early, 3)  # from an older place of the log: position 1 is before the start, 3 is applied
    assert rows(spark.read.parquet(path)) == [(1, "x3")]
    assert rows(handler.applied(), "table_key", "last_id") == [("cdc-h-1-db-t", 6)]


def test_an_unfit_value_is_reported_by_the_stream(spark, rows, lake):
    emit(spark, lake, (1, "t", I, '{"id":"3","v":"z"}'), (2, "t", I, '{"id":"four","v":"w"}'))
    run(spark, lake, applier(spark, lake))
    assert rows(spark.read.parquet(f"{lake}/bad"), "id", "reason") == [(2, "values that do not fit: id")]
