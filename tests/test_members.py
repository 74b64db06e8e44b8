"""Consolidated tables that record their members."""

import pytest

from cdclake.model import Mapping
from cdclake.operators.consolidate import consolidate, map_columns, propagate_changes
from cdclake.operators.members import FED, refresh_member
from cdclake.operators.versioned import propagate_versions
from cdclake.plans.query import run_query
from cdclake.plans.sync import consolidate_table
from cdclake.sources.versions import read_table

MAPPING = [
    Mapping("key", ("a.t.id", "b.u.id", "c.w.id"), unique=True),
    Mapping("name", ("a.t.name", "b.u.name", "c.w.title")),
    Mapping("size", ("a.t.size", "c.w.size")),
]


def member(spark, table, alias, schema, *rows):
    return map_columns(spark.createDataFrame(list(rows), schema), MAPPING, table, alias)


def t(spark, *rows):
    return member(spark, "t", "a", "id bigint, name string, size int, x string", *rows)


def u(spark, *rows):
    return member(spark, "u", "b", "id bigint, name string, y int", *rows)


def w(spark, *rows):
    return member(spark, "w", "c", "id bigint, title string, size bigint", *rows)


def bring(merged, new, table, alias, **options):
    return refresh_member(merged, new, MAPPING, table, alias, **options)


def shown(rows, merged):
    found = rows(merged, "key", "name", "size", "x_t_a", "y_u_b", f"{FED}.member")
    return [(*r[:-1], "".join(m[0] for m in r[-1])) for r in found]


@pytest.fixture
def two(spark):
    first = bring(None, t(spark, (1, "t1", 10, "x1"), (2, "t2", None, "x2"), (None, "tn", 5, "xn")), "t", "a")
    return bring(first, u(spark, (2, "u2", 22), (3, "u3", 33), (1, None, 11), (None, "un", 44)), "u", "b")


def test_values_fall_back_and_rows_go(spark, rows, two):
    assert shown(rows, two) == [
        (None, "tn", 5, "xn", None, "t"), (None, "un", None, None, 44, "u"),
        (1, "t1", 10, "x1", 11, "ut"), (2, "u2", None, "x2", 22, "ut"), (3, "u3", None, None, 33, "u"),
    ]
    fewer = bring(two, u(spark, (1, "u1", 12)), "u", "b")
    assert shown(rows, fewer) == [(None, "tn", 5, "xn", None, "t"), (1, "u1", 10, "x1", 12, "ut"), (2, "t2", None, "x2", None, "t")]
    none = bring(fewer, t(spark), "t", "a")
    assert shown(rows, none) == [(1, "u1", None, None, 12, "u")]
    assert bring(none, u(spark), "u", "b").count() == 0


def test_a_refresh_may_be_repeated(spark, rows, two):
    again = bring(two, u(spark, (2, "u2", 22), (3, "u3", 33), (1, None, 11), (None, "un", 44)), "u", "b")
    assert rows(again) == rows(two)


@pytest.mark.parametrize("measure", [False, True])
def test_a_third_member_with_another_type(spark, rows, two, measure):
    three = bring(two, w(spark, (1, None, 7), (4, "w4", 8)), "w", "c", measure=measure)
    assert [r[:3] + r[5:] for r in shown(rows, three)] == [
        (None, "tn", "5", "t"), (None, "un", None, "u"), (1, "t1", "7", "wut"), (2, "u2", None, "ut"), (3, "u3", None, "u"), (4, "w4", "8", "w"),
    ]
    back = bring(three, w(spark), "w", "c")
    assert [r[:3] + r[5:] for r in shown(rows, back)][2:] == [(1, "t1", "10", "ut"), (2, "u2", None, "ut"), (3, "u3", None, "u")]


def changes(spark, *found):
    return spark.createDataFrame(list(found), "id bigint, name string, y int, operation int, seq bigint")


@pytest.mark.parametrize("measure", [False, True])
def test_changes_of_a_member(spark, rows, two, measure):
    delta = changes(spark, (2, None, None, 3, 1), (3, None, None, 3, 2), (1, "u1", 12, 2, 3), (5, "u5", 55, 1, 4), (9, None, None, 3, 5))
    after = propagate_changes(two, delta, MAPPING, "u", "b", mode="members", measure=measure)
    expected = [
        (None, "tn", 5, "xn", None, "t"), (None, "un", None, None, 44, "u"),
        (1, "u1", 10, "x1", 12, "ut"), (2, "t2", None, "x2", None, "t"), (5, "u5", None, None, 55, "u"),
    ]
    assert shown(rows, after) == expected
    assert shown(rows, propagate_changes(after, delta, MAPPING, "u", "b", mode="members")) == expected


def test_a_column_the_changes_do_not_carry_keeps_its_values(spark, rows, two):
    delta = changes(spark, (2, None, 23, 2, 1)).drop("name")
    after = propagate_changes(two, delta, MAPPING, "u", "b", mode="members")
    assert shown(rows, after)[3] == (2, "u2", None, "x2", 23, "ut")


def test_stored_tables_and_queries(spark, rows, tmp_path):
    path = f"{tmp_path}/party"
    a = spark.createDataFrame([(1, "t1", 1, "x")], "id bigint, name string, size int, x string")
    b = spark.createDataFrame([(1, "u1", 2), (2, "u2", 3)], "id bigint, name string, y int")
    consolidate_table(spark, path, a, MAPPING, "t", "a", track=True)
    consolidate_table(spark, path, b, MAPPING, "u", "b")
    party = consolidate_table(spark, path, b.where("id = 9"), MAPPING, "u", "b")
    assert shown(rows, party) == [(1, "t1", 1, "x", None, "t")]
    assert FED not in run_query(spark, "select * from :merge_request.party:", {"merge_request.party": path}).columns


def test_versions_start_and_go_on(spark, rows, tmp_path):
    path = f"{tmp_path}/party"
    first = changes(spark, (1, "u1", 1, 1, 1), (2, "u2", 2, 1, 2))
    first.write.parquet(f"{tmp_path}/d1")
    propagate_versions(spark, path, spark.read.parquet(f"{tmp_path}/d1"), MAPPING, "u", "b", "members")
    changes(spark, (1, None, None, 3, 3)).write.parquet(f"{tmp_path}/d2")
    propagate_versions(spark, path, spark.read.parquet(f"{tmp_path}/d2"), MAPPING, "u", "b", "members")
    assert rows(read_table(spark, path), "key", "name", f"{FED}.member") == [(2, "u2", ["u_b"])]


def test_a_table_without_a_record_is_refused(spark, two):
    with pytest.raises(ValueError, match="no record"):
        bring(consolidate(t(spark), u(spark), MAPPING), u(spark), "u", "b")
