import pytest
from pyspark.sql import functions as F

from cdclake.operators.schema_drift import (
    catalog_rows, changed_schemas, column_properties, describe_tables, diff_schemas, diff_tables, latest_schemas,
    pack_schemas, record_schemas, schema_alerts, unpack_schemas,
)
from tests.conftest import plan_of

COLUMNS = "db_type string, table_name string, column_name string, ordinal_position int, data_type string, column_default string"


def catalog(spark, *columns, table="t"):
    """Columns as ``(name, type)`` or ``(name, type, default)``."""
    return spark.createDataFrame(
        [("crm", table, c[0], i, c[1], c[2] if len(c) > 2 else None) for i, c in enumerate(columns)], COLUMNS
    )


def diff(spark, old, new):
    return diff_schemas(*[column_properties(catalog(spark, *c), "db_type", "table_name") for c in (old, new)])


@pytest.mark.parametrize("old,new,event", [
    ([], [("a", "int")], ("a", "FIELD_CHANGED", None, "a")),
    ([("a", "int")], [], ("a", "FIELD_CHANGED", "a", None)),
    ([("a", "int")], [("A", "bigint")], ("A", "TYPE_CHANGED", "int", "bigint")),
    ([("a", "varchar(20)")], [("a", "varchar(40)")], ("a", "TYPE_SIZE_CHANGED", "20", "40")),
    ([("a", "varchar")], [("a", "varchar(10)")], ("a", "TYPE_SIZE_CHANGED", "-1", "10")),
    ([("a", "int")], [("a", "int", "0")], ("a", "DEFAULT_VALUE_CHANGED", "NULL", "0")),
    ([("a", "enum('y','x')")], [("a", "enum('x','y','z')")], ("a", "POSSIBLE_VALUE_CHANGE", "[x, y]", "[x, y, z]")),
])
def test_each_kind_of_change(spark, rows, old, new, event):
    assert rows(diff(spark, old, new)) == [("crm", "t", *event)]


@pytest.mark.parametrize("old,new", [
    ([("a", "enum('x','y')")], [("a", "enum('y','x')")]),
    ([("a", "int(11) signed")], [("a", "int(11) unsigned")]),
    ([("a", "int")], [("A", "int")]),
    ([], []),
])
def test_what_is_no_change(spark, rows, old, new):
    assert rows(diff(spark, old, new)) == []


def test_one_column_can_change_in_several_ways(spark, rows):
    events = diff(spark, [("a", "varchar(20)", "x")], [("a", "char(5)", "y")])
    assert rows(events, "changeType") == [("DEFAULT_VALUE_CHANGED",), ("TYPE_CHANGED",), ("TYPE_SIZE_CHANGED",)]


def test_both_sides_meet_in_one_shuffle(spark):
    assert plan_of(diff(spark, [("a", "int")], [("b", "int")])).count("Exchange hashpartitioning") == 1


def test_alerts(spark, rows):
    events = diff(spark, [("gone", "int"), ("kept", "int")], [("new", "int"), ("kept", "bigint")])
    alerts = schema_alerts(events, "db1", created="2024-01-01T00:00:00", owners=(("me", "1"),), process_name="drift")
    assert rows(alerts, "msg", "entity_name") == [
        ("TABLE crm@db1 - FIELD: gone IS DELETED", "crm.t.gone@db1"),
        ("TABLE crm@db1 - FIELD: kept IS CHANGED", "crm.t.kept@db1"),
        ("TABLE crm@db1 - FIELD: new IS ADDED", "crm.t.new@db1"),
    ]
    one = alerts.first()
    assert (one["entity_type"], one["alert_level"], one["alert_cycle"], one["process_name"]) == ("COLUMN", "WARNING", "REALTIME", "drift")
    assert one["owner"][0]["phone"] == "1" and one["metrics"]["dbTable"] == "t"


def test_table_lists(spark, rows):
    old = spark.createDataFrame([("a",), ("B",), ("z",)], "table_name string")
    new = spark.createDataFrame([("b",), ("c",)], "table_name string")
    assert rows(diff_tables(old, new)) == [("a", "removed"), ("b", "common"), ("c", "added"), ("z", "removed")]


def test_versions(spark, rows, tmp_path):
    path = str(tmp_path / "schemas")

    def packed(*columns, table="t"):
        return pack_schemas(column_properties(catalog(spark, *columns, table=table), "db_type", "table_name"))

    first = packed(("b", "int"), ("A", "enum('y','x')")).unionByName(packed(("k", "int"), table="u"))
    record_schemas(first, path, 1)
    current = packed(("b", "bigint"), ("A", "enum('y','x')")).unionByName(packed(("k", "int"), table="u"))
    stored = latest_schemas(spark.read.parquet(path))
    changed = changed_schemas(stored, current)
    assert rows(changed, "table_name") == [("t",)]
    record_schemas(changed, path, 2)
    newest = latest_schemas(spark.read.parquet(path))
    assert rows(newest, "table_name", "id") == [("t", 2), ("u", 1)]
    assert rows(unpack_schemas(newest).select("table_name", "field", "type", "typeSize", F.array_join("possibleValues", ","))) == [
        ("t", "A", "enum", -1, "x,y"), ("t", "b", "bigint", -1, ""), ("u", "k", "int", -1, ""),
    ]


def test_describing_table_copies(spark, rows):
    df = spark.createDataFrame([], "Id bigint, name string, at timestamp")
    described = describe_tables(catalog_rows(spark, {"t": df, "u": df.select("name")}))
    assert rows(described) == [
        ("t", 3, '["id:bigint","name:string","at:timestamp"]'), ("u", 1, '["name:string"]'),
    ]
