"""Inputs of the operators, derived from the test tables so that they grow with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cdclake.model import CHANGE, Mapping, TableRef

HOST, PORT, DATABASE = "db1.example", "3306", "crm"
CUSTOMER = TableRef("mysql", HOST, PORT, DATABASE, "customer")

PARTY_MAPPING = [
    Mapping("party_key", ("crm.customer.c_custkey", "erp.supplier.s_suppkey"), unique=True),
    Mapping("name", ("crm.customer.c_name", "erp.supplier.s_name")),
    Mapping("nation", ("crm.customer.c_nationkey", "erp.supplier.s_nationkey")),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def last_id(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] + 1


def operation_of(event_type: Column) -> Column:
    return F.when(event_type.isin("signup", "purchase"), 1).when(event_type.isin("view", "click"), 2).otherwise(3)


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of the change log, before they are packed into row images."""
    events = table(spark, sf_dir, "events")
    newest = events.select(F.max("event_id") + 1).scalar()
    seq = F.col("event_id") + 1
    # The stored times have no zone and mean UTC, whatever the session's zone is.
    at = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return events.select(
        seq.alias("id"),
        F.unix_seconds(at).alias("created"),
        operation_of(F.col("event_type")).alias("operation"),
        (F.col("user_id") * 20).alias("c_custkey"),
        F.col("value").alias("c_acctbal"),
        F.col("event_type").alias("c_mktsegment"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
        (seq * 2 > newest).alias("second_half"),
    )


def change_log(spark: SparkSession, sf_dir: str, routed: bool = False, damaged: bool = False, unfit: bool = False) -> DataFrame:
    """The change log of one table, or of three with ``routed``; some events unreadable with ``damaged``,
    and with ``unfit`` some with numbers that are none.

    Its second half has a further column, ``k``.
    """
    facts = event_changes(spark, sf_dir)
    base = [F.col(c).cast("string").alias(c) for c in ("c_custkey", "c_acctbal", "c_mktsegment")]
    if unfit:
        k = F.col("k")
        base[0] = F.when(k < 10, F.lit("x1")).otherwise(base[0]).alias("c_custkey")
        base[1] = F.when((k >= 5) & (k < 20), F.lit("n/a")).otherwise(base[1]).alias("c_acctbal")
    text = F.to_json(F.struct(*base))
    wide = F.to_json(F.struct(*base, F.col("k").cast("string").alias("k")))
    schema = '"c_custkey:bigint","c_acctbal:double","c_mktsegment:varchar(10)"'
    name = F.lit("customer")
    if routed:
        which = (F.col("id") - 1) % 3
        name = F.when(which == 0, "customer").when(which == 1, "supplier").otherwise("orders")
    value, operation = F.when(F.col("second_half"), wide).otherwise(text), F.col("operation")
    if damaged:
        k = F.col("k")
        value = F.when(k < 10, F.lit(None)).when(k < 20, F.substring(value, 1, 12)).otherwise(value)
        operation = F.when((k >= 20) & (k < 30), F.lit(9)).otherwise(operation)
    return facts.select(
        "id",
        F.lit(HOST).alias("database_url"),
        F.lit(PORT).alias("database_port"),
        F.lit(DATABASE).alias("database_name"),
        name.alias("table_name"),
        F.when(F.col("second_half"), F.lit(f'[{schema},"k:int"]')).otherwise(F.lit(f"[{schema}]")).alias("schema"),
        value.alias("value"),
        operation.alias("operation"),
        "created",
    ).select(*[f.name for f in CHANGE.fields])


# --- alias catalog: servers, the databases on them, the tables in those ---

def servers(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.lower("n_name").alias("server_host")
    )


def databases(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("server_info_id"),
        F.when(F.col("s_suppkey") % 2 == 0, "mysql").otherwise("postgresql").alias("database_type"),
        F.when(F.col("s_suppkey") % 2 == 0, "3306").otherwise("5432").alias("port"),
        F.lower("s_name").alias("database_name"),
        F.concat(F.lit("db"), F.col("s_suppkey")).alias("alias"),
        F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("deleted"),
    )


def tables(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("bigint").alias("database_info_id"),
        F.concat(F.lit("t_"), F.col("p_partkey")).alias("table_name"),
        F.lit("id").alias("default_key"),
    )


# --- column catalogs: one table per customer, one column per order ---

def column_catalog(spark, sf_dir) -> DataFrame:
    priority, n = F.col("o_orderpriority"), F.col("o_orderkey")
    kind = (
        F.when(F.startswith(priority, F.lit("1")), F.concat(F.lit("varchar("), n % 90 + 10, F.lit(")")))
        .when(F.startswith(priority, F.lit("2")), F.lit("int(11) unsigned"))
        .when(F.startswith(priority, F.lit("3")), F.lit("decimal(12,2)"))
        .when(F.startswith(priority, F.lit("4")), F.concat(F.lit("enum('b','a','c"), n % 3, F.lit("')")))
        .otherwise(F.lit("datetime"))
    )
    return table(spark, sf_dir, "orders").select(
        F.lit("crm").alias("db_type"),
        F.concat(F.lit("t_"), F.col("o_custkey")).alias("table_name"),
        F.concat(F.lit("Col_"), n).alias("column_name"),
        n.cast("int").alias("ordinal_position"),
        kind.alias("data_type"),
        F.when(n % 4 == 0, F.col("o_orderstatus")).alias("column_default"),
        "o_orderstatus",
    )


def old_columns(spark, sf_dir) -> DataFrame:
    """Yesterday's catalog: without the columns added since."""
    return column_catalog(spark, sf_dir).where("o_orderstatus <> 'P'").drop("o_orderstatus")


def new_columns(spark, sf_dir) -> DataFrame:
    """Today's catalog: columns gone, retyped, resized, re-defaulted, or only spelled differently."""
    n = F.col("ordinal_position")
    kind = (
        F.when((n % 5 == 1) & F.startswith("data_type", F.lit("varchar")), F.lit("varchar(255)"))
        .when((n % 5 == 2) & (F.col("data_type") == "datetime"), F.lit("timestamp"))
        .when((n % 5 == 3) & (F.col("data_type") == "datetime"), F.lit("datetime(6)"))
        .when((n % 5 == 3) & F.startswith("data_type", F.lit("decimal")), F.lit("decimal(12,4)"))
        .when((n % 5 == 1) & F.startswith("data_type", F.lit("enum")), F.lit("enum('a','b','new one')"))
        .when((n % 5 == 2) & F.startswith("data_type", F.lit("enum")), F.concat(F.lit("enum('c"), n % 3, F.lit("','a','b')")))
        .when((n % 5 == 4) & F.startswith("data_type", F.lit("int")), F.lit("int(11) signed"))
        .otherwise(F.col("data_type"))
    )
    return (
        column_catalog(spark, sf_dir)
        .where("o_orderstatus <> 'F'")
        .drop("o_orderstatus")
        .withColumns({
            "data_type": kind,
            "column_default": F.when(n % 7 == 0, F.lit("0")).otherwise(F.col("column_default")),
            "column_name": F.when(n % 5 == 0, F.upper("column_name")).otherwise(F.col("column_name")),
        })
    )


# --- merge definitions: one per order, with two or three members ---

def definitions(spark, sf_dir, before: bool = False) -> DataFrame:
    """Merge definitions today, or ``before`` most of them gained their last member."""
    status = F.col("o_orderstatus")
    price_band = F.when(F.col("o_totalprice") > 250000, "F").otherwise("O")

    def member(number: int, table: Column, alias: Column) -> Column:
        return F.struct(
            (F.col("o_orderkey") * 3 + number).alias("table_id"),
            F.concat(F.lit("t_"), table).alias("table"),
            F.concat(F.lit("db_"), alias).alias("database_alias"),
        )

    first = member(0, F.col("o_custkey") % 100, status)
    second = member(1, F.col("o_orderkey") % 100, price_band)
    third = member(2, F.col("o_custkey") % 7, F.lit("X"))
    members = F.array(first, second, third)
    if before:
        members = F.when(status == "P", members).otherwise(F.array(first, second))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("m_"), F.col("o_orderkey")).alias("merge_table_name"), members.alias("list_tables")
    )


# --- run log: one job per order, one step event per line item ---

def run_log(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("job_id"),
        F.col("l_suppkey").alias("request_id"),
        F.col("l_linenumber").alias("step"),
        F.lit("sync_all").alias("request_type"),
        F.lit(12).alias("number_step"),
        F.when(F.col("l_returnflag") == "A", "success").when(F.col("l_returnflag") == "R", "fail")
        .otherwise("processing").alias("status"),
        F.date_format("l_shipdate", "yyyy/MM/dd HH:mm:ss").alias("create_time"),
    )
