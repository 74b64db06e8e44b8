"""User SQL over table copies by alias."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping as MappingABC

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cdclake.model import TableRef, merge_table_path
from cdclake.sources.tables import export_csv
from cdclake.operators.members import FED
from cdclake.sources.versions import read_table

# ``:alias.table:`` or ``:merge_request.name:``
TOKEN = re.compile(r":([A-Za-z0-9_\-]+(?:\.[A-Za-z0-9_\-]+)+):")

RESULT_SCHEMA = (
    "jobId int, requestId int, etlID int, status string, total_rows bigint, result_path string, message_fail string"
)

Catalog = MappingABC[str, "DataFrame | str"] | Callable[[str], "DataFrame | str | None"]


def resolve_aliases(databases: DataFrame, tables: DataFrame, servers: DataFrame) -> DataFrame:
    """Every registered table with where it lives and the alias users call its database by.

    ``databases(id, server_info_id, database_type, port, database_name, alias, deleted)``,
    ``tables(id, database_info_id, table_name, …)``, ``servers(id, server_host, …)``.
    """
    live = databases.where("deleted = 0").select(
        F.col("id").alias("_db"), F.col("server_info_id").alias("_server"), "database_type", "port", "database_name", "alias"
    )
    members = tables.select(
        F.col("id").alias("table_id"), F.col("database_info_id").alias("_db"), "table_name",
        *[c for c in ("default_key", "username") if c in tables.columns],
    )
    hosts = servers.select(F.col("id").alias("_server"), "server_host")
    return members.join(live, "_db").join(hosts, "_server").drop("_db", "_server")


def ordered_aliases(aliases: DataFrame) -> DataFrame:
    """The alias catalog in listing order."""
    return aliases.orderBy("server_host", "port", "table_id")


def alias_of(aliases: DataFrame, host: str, port: str) -> str | None:
    """Alias of the database at an address; the first by name if several share it."""
    row = aliases.where((F.col("server_host") == host) & (F.col("port") == port)).agg(F.min("alias").alias("alias")).first()
    return row["alias"]


def default_key(aliases: DataFrame, host: str, port: str, database: str, table: str) -> str | None:
    """Registered key of a table, for requests that name none."""
    row = (
        aliases.where(
            (F.col("server_host") == host) & (F.col("port") == port)
            & (F.col("database_name") == database) & (F.col("table_name") == table)
        )
        .agg(F.min("default_key").alias("default_key"))
        .first()
    )
    return row["default_key"]


def alias_catalog(spark: SparkSession, aliases: DataFrame, root: str = "/user", merged: tuple[str, ...] = ()) -> Callable[[str], str | None]:
    """A catalog that looks each token up in the alias catalog when a query uses it.

    ``merged`` are the stored names of consolidated tables; one is found whatever
    case a query writes it in, another is taken as written. Oracle copies lie
    under their owner, the catalog's ``username``.
    """
    spelled = {name.lower(): name for name in merged}

    def path_of(token: str) -> str | None:
        space, _, name = token.partition(".")
        if space.lower() == "merge_request":
            return merge_table_path(spelled.get(name.lower(), name), root)
        found = (
            aliases.where((F.lower("alias") == space.lower()) & (F.lower("table_name") == name.lower()))
            .orderBy("server_host", "port", "table_id")
            .limit(1)
            .collect()
        )
        if not found:
            return None
        r = found[0].asDict()
        ref = TableRef(r["database_type"], r["server_host"], r["port"], r["database_name"], r["table_name"], r.get("username") or r["database_name"])
        return ref.path(root)

    return path_of


def run_query(spark: SparkSession, sql: str, catalog: Catalog) -> DataFrame:
    """Run SQL whose table names are ``:alias.table:`` tokens, matched without case.

    The catalog gives a frame or a Parquet path for ``alias.table``; a function
    gets the token as it is written. A token it does not know is an error. Each
    token has a view of its own for the time of this call.
    """
    known = catalog if callable(catalog) else {k.lower(): v for k, v in catalog.items()}
    run, names = uuid.uuid4().hex, {}

    def view_for(match: re.Match) -> str:
        token = match.group(1)
        if token.lower() not in names:
            entry = known(token) if callable(known) else known.get(token.lower())
            if entry is None:
                raise ValueError(f"unknown table :{token}:")
            # The record of a consolidated table's members is no column of the user's.
            frame = (read_table(spark, entry) if isinstance(entry, str) else entry).drop(FED)
            names[token.lower()] = f"q_{run}_{len(names)}"
            frame.createOrReplaceTempView(names[token.lower()])
        return names[token.lower()]

    try:
        # The query is resolved here, so its views may go.
        return spark.sql(TOKEN.sub(view_for, sql))
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)


def run_queries(spark: SparkSession, requests: DataFrame, catalog: Catalog, out_dir: str,
                single_file: bool = False) -> DataFrame:
    """Run query requests and export each result as CSV; one row per request with its outcome.

    A request is an instruction to the driver, so these are walked through
    there. Rows are counted while they are written, not by a second run.
    """
    outcomes = []
    for request in requests.select("jobId", "requestId", "etlID", "query").toLocalIterator():
        job, req, etl = request["jobId"], request["requestId"], request["etlID"]
        try:
            counted = Observation()
            result = run_query(spark, request["query"], catalog).observe(counted, F.count(F.lit(1)).alias("rows"))
            path = export_csv(result, f"{out_dir.rstrip('/')}/id_{req}_{job}_{etl}", single_file)
            outcomes.append((job, req, etl, "success", counted.get["rows"], path, None))
        except Exception as error:  # the outcome of a user's query, whatever it is
            outcomes.append((job, req, etl, "fail", None, None, str(error)))
    return spark.createDataFrame(outcomes, RESULT_SCHEMA)
