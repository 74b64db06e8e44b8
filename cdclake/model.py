"""Record layouts shared by the operators, and the identity of a table copy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INSERT, UPDATE, DELETE = 1, 2, 3

# One row of the change log. ``created`` is in epoch seconds.
CHANGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("database_url", T.StringType()),
    T.StructField("database_port", T.StringType()),
    T.StructField("database_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("operation", T.IntegerType()),
    T.StructField("created", T.LongType()),
])

APPLY_REQUEST = T.StructType([
    T.StructField("server_host", T.StringType()),
    T.StructField("port", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("database_type", T.StringType()),
    T.StructField("identity_key", T.StringType()),
    T.StructField("partition_by", T.StringType()),
    T.StructField("str_id", T.IntegerType()),
    T.StructField("job_id", T.IntegerType()),
    T.StructField("max_retries", T.IntegerType()),
    T.StructField("number_retries", T.IntegerType()),
    T.StructField("latest_offset", T.LongType()),
    T.StructField("database", T.StringType()),
    T.StructField("username", T.StringType()),
])

MERGE_REQUEST = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("port", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("databaseType", T.StringType()),
    T.StructField("database", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("mergeTable", T.StringType()),
    T.StructField("jobID", T.IntegerType()),
    T.StructField("requestID", T.IntegerType()),
])

QUERY_REQUEST = T.StructType([
    T.StructField("jobId", T.IntegerType()),
    T.StructField("requestId", T.IntegerType()),
    T.StructField("etlID", T.IntegerType()),
    T.StructField("query", T.StringType()),
])

MERGE_DEFINITION = T.StructType([
    T.StructField("merge_table_name", T.StringType()),
    T.StructField("list_tables", T.ArrayType(T.StructType([
        T.StructField("table_id", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("database_alias", T.StringType()),
    ]))),
    T.StructField("list_mapping", T.ArrayType(T.StructType([
        T.StructField("colName", T.StringType()),
        T.StructField("listCol", T.ArrayType(T.StringType())),
        T.StructField("is_unique", T.IntegerType()),
    ]))),
])

COLUMN_PROPERTY = T.StructType([
    T.StructField("field", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("typeSize", T.IntegerType()),
    T.StructField("typeScale", T.IntegerType()),
    T.StructField("isSigned", T.BooleanType()),
    T.StructField("defaultValue", T.StringType()),
    T.StructField("possibleValues", T.ArrayType(T.StringType())),
])

SCHEMA_VERSION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("db_type", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("table_schema", T.StringType()),
])

DDL_EVENT = T.StructType([
    T.StructField("dbType", T.StringType()),
    T.StructField("dbTable", T.StringType()),
    T.StructField("fieldChanged", T.StringType()),
    T.StructField("changeType", T.StringType()),
    T.StructField("oldValue", T.StringType()),
    T.StructField("newValue", T.StringType()),
])

RUN_LOG = T.StructType([
    T.StructField("job_id", T.LongType()),
    T.StructField("request_id", T.LongType()),
    T.StructField("host", T.StringType()),
    T.StructField("port", T.StringType()),
    T.StructField("database_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("request_type", T.StringType()),
    T.StructField("number_step", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("statusOrder", T.IntegerType()),
])

# How far a job step got, by status name.
STATUS_ORDER = {"processing": 1, "fail": 2, "success": 3}

# Column naming the load that produced a row; managed by the library on both
# sides of a merge.
MODIFIED = "modified"
MODIFIED_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


@dataclass(frozen=True)
class TableRef:
    """A source table. Oracle copies are filed under the owner, others under the database."""

    system: str
    host: str
    port: str
    database: str
    table: str
    owner: str | None = None

    @property
    def key(self) -> str:
        return "-".join(["cdc", self.host, str(self.port), self.database, self.table.lower()])

    def path(self, root: str = "/user") -> str:
        space = self.owner if self.system == "oracle" else self.database
        return "/".join([root.rstrip("/"), self.system, self.host, str(self.port), str(space), self.table])


def merge_table_path(name: str, root: str = "/user") -> str:
    return f"{root.rstrip('/')}/merge_request/{name}"


@dataclass(frozen=True)
class Mapping:
    """One column of a consolidated table and the member columns that feed it.

    ``sources`` entries read ``alias.table.column``.
    """

    column: str
    sources: tuple[str, ...]
    unique: bool = False

    @staticmethod
    def from_metadata(rows) -> list["Mapping"]:
        """Mappings from the ``list_mapping`` entries of a merge definition."""
        return [Mapping(r["colName"], tuple(r["listCol"] or ()), int(r["is_unique"] or 0) == 1) for r in rows]
