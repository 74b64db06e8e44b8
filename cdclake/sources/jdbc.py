"""Full copies of source tables."""

from __future__ import annotations

import math
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.model import MODIFIED, MODIFIED_FORMAT
from cdclake.sources.tables import replace_table


def jdbc_url(system: str, host: str, port: str | int, database: str) -> str:
    """Connection URL without credentials, which belong in the reader options. For Oracle ``database`` is the SID."""
    if system.lower() == "oracle":
        return f"jdbc:oracle:thin:@{host}:{port}:{database}"
    if system.lower() not in ("mysql", "postgresql"):
        raise ValueError(f"unknown database system {system!r}")
    return f"jdbc:{system.lower()}://{host}:{port}/{database}"


def read_jdbc(spark: SparkSession, options: dict[str, str], partition_column: str | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A source table; with a numeric or date ``partition_column``, through several connections.

    The column's bounds come from the database. They only set the stride:
    values beyond them and NULLs are read as well.
    """
    if partition_column is None:
        return spark.read.format("jdbc").options(**options).load()
    table = options["dbtable"]
    bounds = (
        spark.read.format("jdbc")
        .options(**{k: v for k, v in options.items() if k != "dbtable"})
        .option("query", f"select min({partition_column}) lo, max({partition_column}) hi from {table}")
        .load()
        .first()
    )
    return spark.read.format("jdbc").options(**options, **stride_options(partition_column, bounds[0], bounds[1], num_partitions)).load()


def stride_options(column: str, low, high, num_partitions: int | None) -> dict[str, str]:
    """Reader options for a parallel scan; none for an empty table, which has no bounds.

    Numeric bounds must be whole numbers, also for a decimal column.
    """
    if low is None or high is None:
        return {}

    def bound(value) -> str:
        return str(math.floor(value)) if isinstance(value, (Decimal, float)) else str(value)

    return {
        "partitionColumn": column,
        "lowerBound": bound(low),
        "upperBound": bound(high),
        "numPartitions": str(num_partitions or 32),
    }


# Where each database system lists its columns. Oracle lists those of the
# connecting user; sizes come with the type where the system keeps them apart.
CATALOG_QUERIES = {
    "mysql": """
        select table_name, column_name, ordinal_position, column_type as data_type, column_default
        from information_schema.columns where table_schema = '{space}'""",
    "postgresql": """
        select table_schema || '.' || table_name as table_name, column_name, ordinal_position,
               data_type || case when character_maximum_length is not null then '(' || character_maximum_length || ')'
                                 when data_type = 'numeric' and numeric_precision is not null
                                 then '(' || numeric_precision || ',' || numeric_scale || ')' else '' end as data_type,
               column_default
        from information_schema.columns where table_schema = '{space}'""",
    "oracle": """
        select table_name, column_name, column_id as ordinal_position,
               data_type || case when data_precision is not null then '(' || data_precision || ',' || data_scale || ')'
                                 when data_type = 'NUMBER' and data_scale is not null then '(*,' || data_scale || ')'
                                 when data_type like '%CHAR%' then '(' || data_length || ')' end as data_type,
               cast(null as varchar2(1)) as column_default
        from user_tab_columns""",
}


def catalog_query(system: str, space: str = "") -> str:
    """SQL listing the columns of all tables in a database or schema, in one shape for all systems."""
    if "'" in space:
        raise ValueError(f"not a schema name: {space!r}")
    return " ".join(CATALOG_QUERIES[system.lower()].format(space=space).split())


def read_catalog(spark: SparkSession, system: str, options: dict[str, str], space: str = "") -> DataFrame:
    """The column catalog of a source database, for ``describe_tables`` and schema tracking."""
    listed = spark.read.format("jdbc").options(**options).option("query", catalog_query(system, space)).load()
    lower = listed.select(*[F.col(f"`{c}`").alias(c.lower()) for c in listed.columns])
    return lower.select(
        "table_name", "column_name", F.col("ordinal_position").cast("int").alias("ordinal_position"), "data_type", "column_default"
    )


def stamp_load(df: DataFrame, modified: str | None = None) -> DataFrame:
    """The frame with its load time; the present when none is given."""
    stamp = F.lit(modified) if modified else F.date_format(F.current_timestamp(), MODIFIED_FORMAT)
    return df.withColumn(MODIFIED, stamp)


def snapshot_table(
    spark: SparkSession,
    source: DataFrame | dict[str, str],
    path: str,
    partition_by: str | Iterable[str] = (),
    modified: str | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Copy a source table to Parquet with its load time; the stored copy.

    ``source`` holds JDBC reader options, or is any frame. An earlier copy stays
    readable until the new one is complete.
    """
    if isinstance(source, dict):
        source = read_jdbc(spark, source, partition_column, num_partitions)
    stamped = stamp_load(source, modified)
    replace_table(stamped, path, partition_by)
    # Read back by its own schema: partition values are not to be guessed at.
    return spark.read.schema(stamped.schema).parquet(path)
