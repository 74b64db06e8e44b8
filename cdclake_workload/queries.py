"""Every operator run over the test tables."""

from __future__ import annotations

import json
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cdclake_workload import inputs as fx
from cdclake.functions import percent_of, register_functions, spark_type_name
from cdclake.model import Mapping
from cdclake.operators.align import align_schemas
from cdclake.operators.apply import apply_changes as apply_batch, apply_changes_partitioned as apply_partitioned, apply_to_table
from cdclake.operators.compact import compact_changes
from cdclake.operators.consolidate import (
    consolidate as consolidate_tables, map_columns as map_member, new_members as added_members,
    propagate_changes, targets_of as definitions_of,
)
from cdclake.operators.envelope import (
    decode_changes as decode, decode_envelope as decode_messages, decode_requests as decode_request_messages,
    encode_changes as encode, table_key, typed_entries,
)
from cdclake.operators.members import FED, refresh_member
from cdclake.operators.versioned import apply_to_versions, with_before_images
from cdclake.operators.progress import (
    append_run_log as append_log, cdc_lag as lag_of, change_watermarks as watermarks, latest_per_key as newest_rows,
    run_progress as progress,
)
from cdclake.operators.schema_drift import (
    changed_schemas as changed, column_properties, describe_tables as describe, diff_schemas as diff_columns,
    diff_tables as diff_lists, latest_schemas as latest, pack_schemas, record_schemas as record,
    schema_alerts as alerts, unpack_schemas,
)
from cdclake.plans.sync import consolidate_table as consolidate_stored
from cdclake.plans.query import resolve_aliases as aliases, run_queries as run_requests, run_query as run_sql
from cdclake.session import work_path
from cdclake.sources.jdbc import snapshot_table as snapshot
from cdclake.sources.log import change_messages, read_changes as read_range, route_changes as route, union_changes as union_logs
from cdclake.sources.tables import export_csv as export, write_table as write_table_to
from cdclake.sources.versions import read_table, start_versions
from cdclake.streaming.stream import (
    ApplyRegistry, ChangeApplier, MergeTarget, QueryRunner, TableMerger, TableTarget, read_stream, stream_changes as stream,
    stream_run_log as copy_run_log,
)

KEY = "c_custkey"
LOADED = "2024-02-01 00:00:00.000"


def _rows(spark, sf):
    return decode(fx.change_log(spark, sf), "mysql")[0]


# --- change events ---

def read_changes(spark: SparkSession, sf: str) -> DataFrame:
    newest = fx.last_id(spark, sf)
    events = read_range(fx.change_log(spark, sf), newest // 4, newest // 2)
    return events.select("id", "table_name", "operation", "created")


def union_changes(spark, sf):
    newest = fx.last_id(spark, sf)
    log = fx.change_log(spark, sf, routed=True)
    first, second = read_range(log, 0, newest * 3 // 5), read_range(log, newest * 2 // 5)
    return union_logs(first, second).select("id", "table_name", "operation", "created")


def encode_changes(spark, sf):
    events = encode(
        fx.table(spark, sf, "orders"), 1, source=fx.CUSTOMER, seq=F.col("o_orderkey") + 1,
        created=F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
    )
    rows, _ = decode(events, "mysql")
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def decode_envelope(spark, sf):
    raw = change_messages(fx.change_log(spark, sf, routed=True)).select("value")
    return decode_messages(raw).select("table_key", "id", "table_name", "operation", "created")


def decode_requests(spark, sf):
    """Apply requests, one per supplier and part of the line items, out of a stream that also carries merge requests."""
    line = fx.table(spark, sf, "lineitem")
    apply = F.to_json(F.struct(
        F.lit("h").alias("server_host"), F.col("l_linenumber").cast("string").alias("port"),
        F.concat(F.lit("T_"), F.col("l_partkey")).alias("table"), F.lit("mysql").alias("database_type"),
        F.lit("id").alias("identity_key"), F.lit(3).alias("max_retries"), F.col("l_suppkey").alias("latest_offset"),
        F.lit("shop").alias("database"),
    ))
    merge = F.to_json(F.struct(F.lit("h").alias("host"), F.lit("m").alias("mergeTable")))
    raw = line.select(
        F.when(F.col("l_returnflag") == "N", "merge-request").otherwise("table-change").alias("topic"),
        F.when(F.col("l_returnflag") == "N", merge).otherwise(apply).alias("value"),
    )
    requests = decode_request_messages(raw, "apply", topic="table-change")
    return requests.select("server_host", "port", F.col("table").alias("table_name"), "latest_offset", "topic_cdc")


def decode_changes(spark, sf):
    return decode(fx.change_log(spark, sf), "mysql", modified=LOADED)[0]


def decode_typed_images(spark, sf):
    """Images as PostgreSQL sends them: numbers as numbers, nested values as objects."""
    orders = fx.table(spark, sf, "orders")
    image = F.to_json(F.struct(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_day"),
        F.struct(F.col("o_custkey").alias("c")).alias("customer"), F.when(F.col("o_orderkey") % 2 == 0, True).alias("even"),
    ), {"ignoreNullFields": "false"})
    schema = '["o_orderkey:bigint","o_totalprice:double","o_day:date","customer:jsonb","even:boolean"]'
    changes = orders.select(
        (F.col("o_orderkey") + 1).alias("id"), F.lit(schema).alias("schema"), image.alias("value"), F.lit(2).alias("operation")
    )
    rows, _ = decode(changes, "postgresql")
    return rows.withColumn("o_day", F.col("o_day").cast("string"))


def _encoded(spark, sf, kind):
    """Line items as images whose numbers are text, with source types of one system."""
    lines = fx.table(spark, sf, "lineitem")
    image = F.to_json(F.struct(
        F.concat("l_orderkey", F.lit("_"), "l_linenumber").alias("id"), F.format_string("%.2f", "l_extendedprice").alias("price"),
        F.col("l_quantity").cast("string").alias("qty"), F.lit("2024-01-02 03:04:05").alias("at"),
        F.concat(F.lit("\\x"), F.lower(F.hex(F.col("l_orderkey")))).alias("raw"),
    ))
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.lit(kind).alias("schema"), image.alias("value"), F.lit(1).alias("operation")
    )


def decode_postgresql(spark, sf):
    """A numeric without a size keeps its fraction, a float its digits, bytes their values."""
    kinds = '["id:text","price:numeric","qty:float","at:timestamp without time zone","raw:bytea"]'
    rows, _ = decode(_encoded(spark, sf, kinds), "postgresql")
    return rows.select("id", "price", "qty", F.col("at").cast("string").alias("at"), F.hex("raw").alias("raw"), "seq")


def decode_oracle(spark, sf):
    """A DATE keeps its time, NUMBER(*,2) its digits."""
    kinds = '["id:VARCHAR2(30 CHAR)","price:NUMBER(*,2)","qty:FLOAT(126)","at:DATE"]'
    rows, _ = decode(_encoded(spark, sf, kinds), "oracle")
    return rows.select("id", F.col("price").cast("string").alias("price"), "qty", F.col("at").cast("string").alias("at"), "seq")


def decode_binary(spark, sf):
    """Bytes encoded to images and decoded again."""
    customer = fx.table(spark, sf, "customer").select("c_custkey", F.unhex(F.sha2("c_name", 256)).alias("h"))
    log = encode(customer, 1, source=fx.CUSTOMER, seq=F.col("c_custkey") + 1, created=F.lit(0))
    return decode(log, "mysql")[0].select("c_custkey", F.lower(F.hex("h")).alias("h"))


def decode_quarantine(spark, sf):
    return decode(fx.change_log(spark, sf, damaged=True), "mysql")[1].select("id", "operation", "reason")


def decode_rejects(spark, sf):
    """Events with balances or keys that are no numbers: decoded all the same, and named with the columns they lose."""
    rows, rejected = decode(fx.change_log(spark, sf, unfit=True), "mysql")
    lost = rows.select(F.col("seq").alias("id"), F.col("operation"), "c_custkey", "c_acctbal")
    return rejected.select("id", "reason").join(lost, "id")


def changes_schema(spark, sf):
    return typed_entries(fx.change_log(spark, sf), "mysql")


def route_changes(spark, sf):
    out = work_path(spark, "routed")
    log = fx.change_log(spark, sf, routed=True)
    route(log, out)
    return spark.read.parquet(out).select("table_key", "id", "operation", "created")


# --- compaction and merge ---

def compact_per_operation(spark, sf):
    return compact_changes(_rows(spark, sf), KEY)


def compact_latest(spark, sf):
    return compact_changes(_rows(spark, sf), KEY, mode="latest")


def apply_changes(spark, sf):
    return apply_batch(fx.table(spark, sf, "customer"), _rows(spark, sf), KEY)


def apply_changes_per_operation(spark, sf):
    return apply_batch(fx.table(spark, sf, "customer"), _rows(spark, sf), KEY, compact="per_operation")


def apply_changes_type_conflict(spark, sf):
    customer = fx.table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
    return apply_batch(customer, _rows(spark, sf), KEY)


def replace_table(spark, sf):
    path = work_path(spark, "customer")
    write_table_to(fx.table(spark, sf, "customer"), path)
    return apply_to_table(spark, path, _rows(spark, sf), KEY)


def apply_changes_partitioned(spark, sf):
    path = work_path(spark, "customer")
    write_table_to(fx.table(spark, sf, "customer"), path, "c_mktsegment")
    rows = _rows(spark, sf)
    # The column added half-way rewrites the table; after that only the touched partitions.
    newest = fx.last_id(spark, sf)
    apply_partitioned(spark, path, rows.where(F.col("seq") <= newest // 3), KEY, "c_mktsegment")
    return apply_partitioned(spark, path, rows.where(F.col("seq") > newest // 3), KEY, "c_mktsegment")


def _versioned_customer(spark, sf):
    """Three versions of customer: as it was, after a third of the log, which brings a column, and after the rest."""
    path = work_path(spark, "customer")
    start_versions(fx.table(spark, sf, "customer"), path, "c_mktsegment")
    rows, newest = _rows(spark, sf), fx.last_id(spark, sf)
    apply_to_versions(spark, path, rows.where(F.col("seq") <= newest // 3), KEY, "c_mktsegment")
    apply_to_versions(spark, path, rows.where(F.col("seq") > newest // 3), KEY, "c_mktsegment")
    return path


def apply_changes_versioned(spark, sf):
    return read_table(spark, _versioned_customer(spark, sf))


def read_versions(spark, sf):
    """Every version of the table as it was."""
    path = _versioned_customer(spark, sf)
    first, second, third = (
        read_table(spark, path, n).groupBy("c_mktsegment").agg(F.count("*").alias("n_rows"), F.max(KEY).alias("greatest"))
        .withColumn("version", F.lit(n)) for n in (1, 2, 3)
    )
    return first.unionByName(second).unionByName(third)


def align_schemas_string(spark, sf):
    left = fx.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_name")
    right = fx.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("C_CUSTKEY"), F.col("o_orderkey").alias("c_acctbal"), "o_orderstatus"
    )
    a, b = align_schemas(left, right)
    return a.unionByName(b)


def align_schemas_widen(spark, sf):
    left = fx.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("v"))
    right = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("n"), F.lit(1).alias("v"))
    a, b = align_schemas(left, right, on_conflict="widen")
    return a.unionByName(b)


# --- consolidated tables ---

def _customer(spark, sf):
    return map_member(fx.table(spark, sf, "customer"), fx.PARTY_MAPPING, "customer", "crm")


def _party(spark, sf):
    supplier = map_member(fx.table(spark, sf, "supplier"), fx.PARTY_MAPPING, "supplier", "erp")
    return consolidate_tables(_customer(spark, sf), supplier, fx.PARTY_MAPPING)


def map_columns(spark, sf):
    return _customer(spark, sf)


def consolidate(spark, sf):
    return _party(spark, sf)


def consolidate_many_to_one(spark, sf):
    """Orders and customers by customer: the key repeats on one side, and types of a mapped column differ."""
    mapping = [
        Mapping("party", ("a.orders.o_custkey", "b.customer.c_custkey"), unique=True),
        Mapping("amount", ("a.orders.o_orderkey", "b.customer.c_mktsegment")),
    ]
    orders = map_member(fx.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), mapping, "orders", "a")
    customer = map_member(fx.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), mapping, "customer", "b")
    return consolidate_tables(orders, customer, mapping)


def propagate_replace(spark, sf):
    delta = compact_changes(_rows(spark, sf), KEY, mode="latest")
    return propagate_changes(_party(spark, sf), delta, fx.PARTY_MAPPING, "customer", "crm")


def propagate_patch(spark, sf):
    return propagate_changes(_party(spark, sf), _rows(spark, sf), fx.PARTY_MAPPING, "customer", "crm", mode="patch")


def _moved(spark, sf, mode):
    """Every third customer gets a new value in the column that consolidated rows are matched by; every fifth other one goes."""
    customer, supplier = fx.table(spark, sf, "customer"), fx.table(spark, sf, "supplier")
    mapping = [
        Mapping("party_key", ("crm.customer.code", "erp.supplier.s_suppkey"), unique=True), Mapping("name", ("erp.supplier.s_name",)),
    ]
    copy = customer.select(KEY, F.col(KEY).alias("code"), "c_acctbal")
    party = consolidate_tables(
        map_member(copy, mapping, "customer", "crm"),
        map_member(supplier.select("s_suppkey", "s_name", "s_acctbal"), mapping, "supplier", "erp"), mapping,
    )
    moves = F.col(KEY) % 3 == 0
    changes = customer.where(moves | (F.col(KEY) % 5 == 0)).select(
        KEY, F.when(moves, F.col(KEY) + 1_000_000).alias("code"), F.when(moves, F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.when(moves, 2).otherwise(3).alias("operation"), F.col(KEY).alias("seq"),
    )
    full = with_before_images(changes, copy, KEY, mapping, "customer", "crm")
    return propagate_changes(party, full, mapping, "customer", "crm", mode)


def propagate_moved_key(spark, sf):
    return _moved(spark, sf, "replace")


def propagate_moved_key_patch(spark, sf):
    return _moved(spark, sf, "patch")


def targets_of(spark, sf):
    return definitions_of(fx.definitions(spark, sf), "t_5", "db_F").select("merge_table_name")


def new_members(spark, sf):
    return added_members(fx.definitions(spark, sf, before=True), fx.definitions(spark, sf)).select(
        "merge_table_name", "table_id", F.col("table").alias("table_name"), "database_alias"
    )


# --- schema history ---

def describe_tables(spark, sf):
    described = describe(fx.column_catalog(spark, sf))
    listed = F.array_join(F.from_json("schema", "array<string>"), ",")
    return described.select("table_name", "column_count", listed.alias("columns"))


def parse_source_types(spark, sf):
    properties = column_properties(fx.new_columns(spark, sf), "table_name")
    return properties.withColumn("possibleValues", F.array_join("possibleValues", ","))


def map_source_types(spark, sf):
    return fx.new_columns(spark, sf).select("table_name", "column_name", spark_type_name("data_type").alias("spark_type"))


def _versions(spark, sf):
    path = work_path(spark, "schemas")
    stored = pack_schemas(column_properties(fx.old_columns(spark, sf), "db_type", "table_name"))
    record(stored, path, 1)
    current = pack_schemas(column_properties(fx.new_columns(spark, sf), "db_type", "table_name"))
    record(changed(latest(spark.read.parquet(path)), current), path, 2)
    return spark.read.parquet(path)


def record_schemas(spark, sf):
    return _versions(spark, sf).select("id", "db_type", "table_name")


def latest_schemas(spark, sf):
    columns = unpack_schemas(latest(_versions(spark, sf)))
    return columns.withColumn("possibleValues", F.array_join("possibleValues", ","))


def diff_tables(spark, sf):
    orders = fx.table(spark, sf, "orders")
    name = F.concat(F.lit("Tab_"), F.col("o_custkey"))
    old = orders.where("o_orderstatus = 'F'").select(name.alias("table_name"))
    new = orders.where("o_orderstatus <> 'F'").select(F.upper(name).alias("table_name"))
    return diff_lists(old, new)


def _events(spark, sf):
    return diff_columns(
        column_properties(fx.old_columns(spark, sf), "db_type", "table_name"),
        column_properties(fx.new_columns(spark, sf), "db_type", "table_name"),
    )


def diff_schemas(spark, sf):
    return _events(spark, sf)


def schema_alerts(spark, sf):
    return alerts(_events(spark, sf), "db1.example", created="2024-02-01T00:00:00").select(
        "msg", "created", "entity_name", "entity_type", "alert_level", "alert_cycle", F.col("metrics.changeType").alias("changeType")
    )


def consolidate_table(spark, sf):
    """Two members brought into a stored consolidated table."""
    path = work_path(spark, "party")
    consolidate_stored(spark, path, fx.table(spark, sf, "customer"), fx.PARTY_MAPPING, "customer", "crm")
    return consolidate_stored(spark, path, fx.table(spark, sf, "supplier"), fx.PARTY_MAPPING, "supplier", "erp")


# --- user queries ---

def consolidate_refresh(spark, sf):
    """A member merged, and merged again after its balances changed and every third row went."""
    path = work_path(spark, "party")
    members = [("customer", "crm"), ("supplier", "erp")]
    for table, alias in members:
        consolidate_stored(spark, path, fx.table(spark, sf, table), fx.PARTY_MAPPING, table, alias)
    newer = fx.table(spark, sf, "supplier").where("s_suppkey % 3 <> 0").withColumn("s_acctbal", F.col("s_acctbal") + 1)
    return consolidate_stored(spark, path, newer, fx.PARTY_MAPPING, "supplier", "erp")


def _fed_by(party):
    return party.withColumn("fed_by", F.array_join(F.transform(FED, lambda e: e["member"]), ",")).drop(FED)


def consolidate_members(spark, sf):
    """As ``consolidate_refresh`` in a table that records its members: what the third rows gave goes with them."""
    path = work_path(spark, "party")
    supplier = fx.table(spark, sf, "supplier")
    newer = supplier.where("s_suppkey % 3 <> 0").withColumn("s_acctbal", F.col("s_acctbal") + 1)
    for member, table, alias in [(fx.table(spark, sf, "customer"), "customer", "crm"), (supplier, "supplier", "erp"), (newer, "supplier", "erp")]:
        party = consolidate_stored(spark, path, member, fx.PARTY_MAPPING, table, alias, track=True)
    return _fed_by(party)


def propagate_members(spark, sf):
    """Changes of customer in a table that records its members; suppliers keep what they gave."""
    supplier = map_member(fx.table(spark, sf, "supplier"), fx.PARTY_MAPPING, "supplier", "erp")
    first = refresh_member(None, _customer(spark, sf), fx.PARTY_MAPPING, "customer", "crm")
    party = refresh_member(first, supplier, fx.PARTY_MAPPING, "supplier", "erp")
    delta = compact_changes(_rows(spark, sf), KEY, mode="latest")
    return _fed_by(propagate_changes(party, delta, fx.PARTY_MAPPING, "customer", "crm", mode="members"))


def resolve_aliases(spark, sf):
    return aliases(fx.databases(spark, sf), fx.tables(spark, sf), fx.servers(spark, sf))


def _catalog(spark, sf):
    return {
        "crm.customer": f"{sf}/customer.parquet",
        "shop-1.Orders": f"{sf}/orders.parquet",
        "merge_request.party": _party(spark, sf),
    }


REVENUE_SQL = """
    select c.c_mktsegment, o.o_orderstatus, count(*) as orders, count(p.s_acctbal_supplier_erp) as suppliers,
           max(o.o_totalprice) as largest
    from :CRM.customer: c join :shop-1.orders: o on c.c_custkey = o.o_custkey
    join :merge_request.party: p on p.party_key = c.c_custkey
    group by c.c_mktsegment, o.o_orderstatus
"""


def run_query(spark, sf):
    return run_sql(spark, REVENUE_SQL, _catalog(spark, sf))


def run_queries(spark, sf):
    requests = spark.createDataFrame(
        [
            (1, 10, 100, "select * from :crm.customer: where c_acctbal > 0"),
            (2, 20, 200, "select o_orderstatus, count(*) as n from :shop-1.orders: group by o_orderstatus"),
            (3, 30, 300, "select * from :crm.missing:"),
        ],
        "jobId int, requestId int, etlID int, query string",
    )
    return run_requests(spark, requests, _catalog(spark, sf), work_path(spark, "results")).select(
        "jobId", "requestId", "status", "total_rows"
    )


def export_csv(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = export(orders, work_path(spark, "csv"))
    return spark.read.option("header", True).schema(orders.schema).csv(path)


def percent_returned(spark, sf):
    sums = fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)).alias("closed"),
        F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"), F.col("l_quantity")).otherwise(0.0)).alias("returned"),
    )
    return sums.select("l_suppkey", percent_of("closed", "returned").alias("percent"))


def percent_by_sql(spark, sf):
    register_functions(spark)
    return run_sql(
        spark,
        "select l_orderkey, percent_recover(sum(l_quantity), sum(case when l_returnflag = 'R' then l_quantity else 0 end)) as percent "
        "from :shop.lineitem: group by l_orderkey",
        {"shop.lineitem": f"{sf}/lineitem.parquet"},
    )


# --- progress ---

def change_watermarks(spark, sf):
    return watermarks(fx.change_log(spark, sf, routed=True))


def server_watermarks(spark, sf):
    return watermarks(fx.change_log(spark, sf, routed=True), by="server")


def cdc_lag(spark, sf):
    log = fx.change_log(spark, sf, routed=True)
    # The orders stream was never applied, the customer stream wholly, the supplier stream by half.
    newest = fx.last_id(spark, sf)
    applied = (
        log.where(F.col("table_name") != "orders")
        .where((F.col("table_name") == "customer") | (F.col("id") <= newest // 2))
        .groupBy(table_key().alias("table_key")).agg(F.max("id").alias("last_id"))
    )
    return lag_of(log, applied)


def latest_per_key(spark, sf):
    return newest_rows(fx.table(spark, sf, "lineitem"), "l_suppkey", ["l_shipdate", "l_quantity"])


def run_progress(spark, sf):
    return progress(fx.run_log(spark, sf))


def append_run_log(spark, sf):
    path = work_path(spark, "runs")
    append_log(fx.run_log(spark, sf), path)
    return spark.read.parquet(path).select("job_id", "request_id", "step", "status", "statusOrder", "create_time", "number_step")


# --- copies and streams ---

def snapshot_table(spark, sf):
    return snapshot(spark, fx.table(spark, sf, "orders"), work_path(spark, "orders"), "o_orderstatus", modified=LOADED)


def stream_changes(spark, sf):
    """The log as a file stream, applied to a copy of customer and passed on to a consolidated table."""
    base = work_path(spark, "stream")
    write_table_to(fx.table(spark, sf, "customer"), f"{base}/customer")
    fx.change_log(spark, sf).write.parquet(f"{base}/log")
    applier = ChangeApplier(
        spark,
        {fx.CUSTOMER.key: TableTarget(f"{base}/customer", KEY, "customer")},
        state=f"{base}/applied", quarantine=f"{base}/quarantine",
    )
    stream(spark, f"{base}/log", applier, f"{base}/checkpoint", format="parquet", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/customer")


def stream_late_events(spark, sf):
    """The log in two batches, the second with events from before the first's last one: those are set aside."""
    base = work_path(spark, "late")
    write_table_to(fx.table(spark, sf, "customer"), f"{base}/customer")
    log, middle = fx.change_log(spark, sf), fx.last_id(spark, sf) // 2
    applier = ChangeApplier(
        spark, {fx.CUSTOMER.key: TableTarget(f"{base}/customer", KEY, "customer")},
        state=f"{base}/applied", quarantine=f"{base}/quarantine",
    )
    applier(log.where((F.col("id") <= middle) & (F.col("id") % 7 != 0)), 0)
    applier(log.where((F.col("id") > middle) | (F.col("id") % 7 == 0)), 1)
    return spark.read.parquet(f"{base}/quarantine").select("id", "operation", "reason")


def stream_restarted(spark, sf):
    """Three batches, the second numbered from 0 again, the last with the first's number, some of its events, and late ones."""
    base = work_path(spark, "restarted")
    log, newest = fx.change_log(spark, sf), fx.last_id(spark, sf)
    applier = ChangeApplier(
        spark, {fx.CUSTOMER.key: TableTarget(f"{base}/customer", KEY, "customer")},
        state=f"{base}/applied", quarantine=f"{base}/quarantine",
    )
    n, in_order = F.col("id"), F.col("id") % 7 != 0
    applier(log.where((n <= newest // 3) & in_order), 3)
    applier(log.where((n > newest // 3) & (n <= newest * 2 // 3) & in_order), 0)
    applier(log.where((n > newest * 2 // 3) | (n <= newest // 6) | ~in_order), 3)
    return spark.read.parquet(f"{base}/quarantine").select("id", "operation", "reason")


def stream_failing_table(spark, sf):
    """A table that cannot be written beside one that can: after two tries it is set aside, and the other moves on."""
    base = work_path(spark, "failing")
    log, middle = fx.change_log(spark, sf, routed=True), fx.last_id(spark, sf) // 2
    fx.table(spark, sf, "region").select("r_name").write.text(f"{base}/supplier")  # no Parquet
    key_of = {t: fx.CUSTOMER.key.replace("customer", t) for t in ("customer", "supplier")}
    applier = ChangeApplier(
        spark, {key: TableTarget(f"{base}/{t}", KEY, t) for t, key in key_of.items()},
        state=f"{base}/applied", quarantine=f"{base}/quarantine", max_retries=2,
    )
    first = log.where(F.col("id") <= middle)
    with suppress(PySparkException, Py4JJavaError):  # a stream would run the batch again
        applier(first, 0)
    applier(first, 0)
    applier(log.where(F.col("id") > middle), 1)
    aside = spark.read.parquet(f"{base}/quarantine").groupBy("table_key", "reason").agg(F.count("*").alias("n"))
    return aside.unionByName(applier.applied().select("table_key", F.lit("applied").alias("reason"), F.col("last_id").alias("n")))


def stream_apply_requests(spark, sf):
    """Half the log before any request, then requests for customer and supplier, the latter from a quarter on, then the rest.

    The copies after that, and how many events stay without a target.
    """
    base = work_path(spark, "requests")
    log, newest = fx.change_log(spark, sf, routed=True), fx.last_id(spark, sf)
    for name in ("customer", "supplier"):
        write_table_to(fx.table(spark, sf, "customer"), f"{base}/mysql/{fx.HOST}/{fx.PORT}/{fx.DATABASE}/{name}")
    registry = ApplyRegistry(spark, f"{base}/registry", base)
    applier = ChangeApplier(spark, registry, state=f"{base}/applied", quarantine=f"{base}/quarantine")
    applier(log.where(F.col("id") <= newest // 2), 0)
    request = F.to_json(F.struct(
        F.col("database_url").alias("server_host"), F.col("database_port").alias("port"), F.col("database_name").alias("database"),
        F.col("table_name").alias("table"), F.lit("mysql").alias("database_type"),
        F.when(F.col("table_name") != "orders", F.lit(KEY)).alias("identity_key"),
        F.when(F.col("table_name") == "supplier", F.lit(newest // 4)).otherwise(F.lit(0)).alias("latest_offset"),
    ))
    log.select(request.alias("value")).distinct().write.parquet(f"{base}/messages")
    messages = read_stream(spark, f"{base}/messages", "parquet", T.StructType([T.StructField("value", T.StringType())]))
    stream(spark, messages, registry, f"{base}/checkpoint", once=True).awaitTermination()
    applier(log.where(F.col("id") > newest // 2), 1)
    copies = [spark.read.parquet(t.path).withColumn("copy", F.lit(t.table)) for t in registry().values()]
    aside = spark.read.parquet(f"{base}/quarantine").where("table_key like '%-orders'")
    refused = registry.requests().where("not valid").select(F.concat_ws(" ", "table", "reason").alias("copy"))
    counts = aside.groupBy("reason").agg(F.count("*").alias(KEY)).withColumnRenamed("reason", "copy")
    whole = copies[0].unionByName(copies[1]).unionByName(counts, allowMissingColumns=True)
    return whole.unionByName(refused, allowMissingColumns=True)


def stream_to_versions(spark, sf):
    """A copy and a consolidated table kept as versions, fed by a stream."""
    base = work_path(spark, "stream")
    start_versions(fx.table(spark, sf, "customer"), f"{base}/customer", "c_mktsegment")
    start_versions(_party(spark, sf), f"{base}/party")
    fx.change_log(spark, sf).write.parquet(f"{base}/log")
    merge = MergeTarget(f"{base}/party", fx.PARTY_MAPPING, "crm", versioned=True)
    applier = ChangeApplier(
        spark,
        {fx.CUSTOMER.key: TableTarget(f"{base}/customer", KEY, "customer", partition_by="c_mktsegment", merges=[merge], versioned=True)},
        state=f"{base}/applied", quarantine=f"{base}/quarantine",
    )
    stream(spark, f"{base}/log", applier, f"{base}/checkpoint", format="parquet", once=True).awaitTermination()
    return read_table(spark, f"{base}/party")


def stream_to_merge_table(spark, sf):
    base = work_path(spark, "stream")
    write_table_to(fx.table(spark, sf, "customer"), f"{base}/customer", "c_mktsegment")
    write_table_to(_party(spark, sf), f"{base}/party")
    fx.change_log(spark, sf).write.json(f"{base}/log")
    applier = ChangeApplier(
        spark,
        {fx.CUSTOMER.key: TableTarget(
            f"{base}/customer", KEY, "customer", partition_by="c_mktsegment",
            merges=[MergeTarget(f"{base}/party", fx.PARTY_MAPPING, "crm")],
        )},
        state=f"{base}/applied", quarantine=f"{base}/quarantine",
    )
    stream(spark, f"{base}/log", applier, f"{base}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/party")


def _messages(spark, path, requests):
    """A stream of request messages, one JSON text each."""
    spark.createDataFrame([(json.dumps(r),) for r in requests], "value string").write.parquet(path)
    return read_stream(spark, path, "parquet", T.StructType([T.StructField("value", T.StringType())]))


def stream_merge_requests(spark, sf):
    base = work_path(spark, "merge")
    members = {"customer": "crm", "supplier": "erp"}
    for name in members:
        write_table_to(fx.table(spark, sf, name), f"{base}/mysql/{name}-host/3306/shop/{name}")
    merger = TableMerger(spark, {"party": fx.PARTY_MAPPING}, lambda host, port: members[host.removesuffix("-host")], base)
    requests = [
        {"host": f"{n}-host", "port": "3306", "table": n, "databaseType": "mysql", "database": "shop", "mergeTable": "party", "jobID": 1}
        for n in members
    ]
    for request in requests:
        source = _messages(spark, work_path(spark, "requests"), [request])
        stream(spark, source, merger, work_path(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(f"{base}/merge_request/party")


def stream_queries(spark, sf):
    base = work_path(spark, "queries")
    source = _messages(spark, f"{base}/requests", [
        {"jobId": 1, "requestId": 10, "etlID": 1, "query": "select * from :crm.customer: where c_acctbal > 0"},
        {"jobId": 2, "requestId": 10, "etlID": 2, "query": "select o_custkey from :shop-1.orders: group by o_custkey"},
    ])
    runner = QueryRunner(spark, _catalog(spark, sf), f"{base}/results", f"{base}/outcomes")
    stream(spark, source, runner, f"{base}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/outcomes").select("jobId", "requestId", "etlID", "status", "total_rows")


def stream_run_log(spark, sf):
    base = work_path(spark, "runs")
    append_log(fx.run_log(spark, sf), f"{base}/in")
    copy_run_log(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("job_id", "request_id", "step", "status", "statusOrder", "create_time", "number_step")


def write_table(spark, sf):
    path = work_path(spark, "orders")
    write_table_to(fx.table(spark, sf, "orders"), path, "o_orderstatus,o_orderpriority")
    return spark.read.parquet(path)


ALL = [
    read_changes, union_changes, encode_changes, decode_envelope, decode_requests, decode_changes, decode_typed_images,
    decode_quarantine, decode_postgresql, decode_oracle, decode_binary, stream_late_events, consolidate_refresh,
    changes_schema, route_changes, compact_per_operation, compact_latest, apply_changes, apply_changes_per_operation,
    apply_changes_type_conflict, replace_table, apply_changes_partitioned, align_schemas_string, align_schemas_widen,
    map_columns, consolidate, consolidate_many_to_one, propagate_replace, propagate_patch, targets_of, new_members,
    describe_tables, parse_source_types, map_source_types, record_schemas, latest_schemas, diff_tables, diff_schemas,
    schema_alerts, resolve_aliases, run_query, run_queries, export_csv, percent_returned, percent_by_sql,
    change_watermarks, cdc_lag, latest_per_key, run_progress, append_run_log, snapshot_table, stream_changes,
    stream_to_merge_table, consolidate_table, server_watermarks, stream_merge_requests, stream_queries, stream_run_log, write_table,
    apply_changes_versioned, read_versions, propagate_moved_key, propagate_moved_key_patch, stream_restarted,
    stream_failing_table, stream_to_versions, decode_rejects, stream_apply_requests,
    consolidate_members, propagate_members,
]
