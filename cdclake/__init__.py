"""Parquet copies of relational tables, kept current from a change log, combined and queried with Spark."""

from cdclake.functions import map_source_type, parse_source_type, percent_of, register_functions, spark_type_name
from cdclake.model import Mapping, TableRef, merge_table_path
from cdclake.operators.align import align_schemas
from cdclake.operators.apply import apply_changes, apply_changes_partitioned, apply_to_table
from cdclake.operators.compact import compact_changes
from cdclake.operators.consolidate import consolidate, map_columns, new_members, propagate_changes, targets_of
from cdclake.operators.envelope import changes_schema, decode_changes, decode_envelope, decode_requests, encode_changes
from cdclake.operators.members import refresh_member, with_member
from cdclake.operators.progress import append_run_log, cdc_lag, change_watermarks, latest_per_key, run_progress
from cdclake.operators.schema_drift import (
    describe_tables, diff_schemas, diff_tables, latest_schemas, record_schemas, schema_alerts,
)
from cdclake.plans.query import resolve_aliases, run_queries, run_query
from cdclake.plans.sync import MergeTarget, TableTarget, consolidate_table
from cdclake.session import build_session
from cdclake.sources.jdbc import read_catalog, read_jdbc, snapshot_table
from cdclake.sources.log import read_changes, read_topic, route_changes, union_changes
from cdclake.operators.versioned import apply_to_versions, merge_versions, propagate_versions, with_before_images
from cdclake.sources.versions import history, merge_small_files, read_table, remove_unreferenced, start_versions
from cdclake.sources.tables import export_csv, recover_table, replace_table, write_table
from cdclake.streaming.stream import ApplyRegistry, ChangeApplier, QueryRunner, TableMerger, stream_changes, stream_run_log

__all__ = [
    "ApplyRegistry", "ChangeApplier", "Mapping", "MergeTarget", "QueryRunner", "TableMerger", "TableRef", "TableTarget", "align_schemas",
    "append_run_log", "apply_changes", "apply_changes_partitioned", "apply_to_table", "apply_to_versions", "build_session", "cdc_lag",
    "change_watermarks", "changes_schema", "compact_changes", "consolidate", "consolidate_table", "decode_changes",
    "decode_envelope", "decode_requests", "describe_tables", "diff_schemas", "diff_tables", "encode_changes", "export_csv",
    "history", "latest_per_key", "latest_schemas", "map_columns", "map_source_type", "merge_small_files", "merge_table_path", "merge_versions", "new_members",
    "parse_source_type", "percent_of", "propagate_changes", "propagate_versions", "read_catalog", "read_changes", "read_jdbc", "read_table", "read_topic",
    "record_schemas", "recover_table", "refresh_member", "register_functions", "remove_unreferenced", "replace_table", "resolve_aliases", "route_changes",
    "run_progress", "run_queries", "run_query", "schema_alerts", "snapshot_table", "spark_type_name", "stream_changes",
    "start_versions", "stream_run_log", "targets_of", "union_changes", "with_before_images", "with_member", "write_table",
]
