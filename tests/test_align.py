import pytest

from cdclake.operators.align import align_schemas


def frame(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def names(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def test_added_and_removed_columns(spark, rows):
    a, b = align_schemas(frame(spark, "id int, gone string", (1, "x")), frame(spark, "ID int, zz_new date", (2, None)))
    assert names(a) == names(b) == [("id", "int"), ("gone", "string"), ("zz_new", "date")]
    assert rows(a.unionByName(b)) == [(1, "x", None), (2, None, None)]


def test_a_new_column_that_sorts_last_is_kept(spark):
    a, _ = align_schemas(frame(spark, "a int, b int", (1, 1)), frame(spark, "a int, b int, zzz int", (1, 1, 1)))
    assert a.columns == ["a", "b", "zzz"]


def test_a_type_conflict_makes_both_strings(spark, rows):
    a, b = align_schemas(frame(spark, "v double", (1.5,)), frame(spark, "V string", ("x",)))
    assert names(a) == names(b) == [("v", "string")]
    assert rows(a.unionByName(b)) == [("1.5",), ("x",)]


@pytest.mark.parametrize("left,right,common", [
    ("int", "bigint", "bigint"), ("int", "float", "double"), ("bigint", "double", "string"), ("smallint", "float", "float"),
    ("decimal(10,2)", "int", "decimal(12,2)"), ("bigint", "date", "string"), ("decimal(38,10)", "bigint", "decimal(38,10)"), ("decimal(38,20)", "bigint", "string"),
])
def test_widening_keeps_every_value(spark, left, right, common):
    a, _ = align_schemas(frame(spark, f"v {left}", (None,)), frame(spark, f"v {right}", (None,)), on_conflict="widen")
    assert names(a) == [("v", common)]


def test_decimals_and_timestamps_are_no_conflict(spark):
    a, b = align_schemas(
        frame(spark, "d decimal(10,2), t timestamp_ntz", (None, None)), frame(spark, "d decimal(12,4), t timestamp", (None, None))
    )
    assert names(a) == names(b) == [("d", "decimal(12,4)"), ("t", "timestamp_ntz")]


def test_a_conflict_can_be_an_error(spark):
    with pytest.raises(ValueError, match="v is int"):
        align_schemas(frame(spark, "v int", (1,)), frame(spark, "v string", ("1",)), on_conflict="error")


def test_columns_differing_only_in_case_are_refused(spark):
    with pytest.raises(ValueError):
        align_schemas(frame(spark, "v int, V int", (1, 1)), frame(spark, "v int", (1,)))
