import random

import pytest
from pyspark.sql import functions as F

from cdclake.model import MERGE_DEFINITION, Mapping
from cdclake.operators.consolidate import (
    consolidate, map_columns, new_members, propagate_changes, targets_of,
)
from tests.conftest import plan_of

I, U, D = 1, 2, 3
MAPPING = [
    Mapping("key", ("crm.customer.id", "erp.supplier.code"), unique=True),
    Mapping("name", ("crm.customer.name", "erp.supplier.label")),
    Mapping("city", ("crm.customer.town",)),
]


@pytest.fixture
def customer(spark):
    df = spark.createDataFrame([(1, "ann", 1.5), (2, None, 2.5), (None, "nokey", 3.5)], "ID int, name string, bal double")
    return map_columns(df, MAPPING, "customer", "crm")


@pytest.fixture
def supplier(spark):
    df = spark.createDataFrame([(2, "bob", True), (3, "cid", False), (None, "none", True)], "code int, label string, ok boolean")
    return map_columns(df, MAPPING, "supplier", "erp")


def test_mapped_and_suffixed_names(spark):
    df = spark.createDataFrame([(1, "x", 2, 1)], "ID int, name string, Bal int, operation int")
    assert map_columns(df, MAPPING, "customer", "crm").columns == ["key", "name", "bal_customer_crm", "operation"]
    assert map_columns(df, MAPPING, "app.customer", "x").columns == [
        "id_app_customer_x", "name_app_customer_x", "bal_app_customer_x", "operation"
    ]


@pytest.mark.parametrize("how", [{}, {"trust_unique": True}, {"measure": True}])
def test_consolidation(spark, rows, customer, supplier, how):
    merged = consolidate(customer, supplier, MAPPING, **how)
    assert merged.columns == ["key", "name", "bal_customer_crm", "ok_supplier_erp"]
    assert rows(merged) == [
        (None, "nokey", 3.5, None), (None, "none", None, True), (1, "ann", 1.5, None), (2, "bob", 2.5, True), (3, "cid", None, False),
    ]


def test_the_first_member_is_the_table(spark, rows, customer):
    assert rows(consolidate(None, customer, MAPPING)) == rows(customer)


def test_types_stay_when_equal_and_become_text_in_conflict(spark, rows, customer):
    df = spark.createDataFrame([("2", 9)], "code string, label int")
    merged = consolidate(customer, map_columns(df, MAPPING, "supplier", "erp"), MAPPING)
    assert dict(merged.dtypes) == {"key": "string", "name": "string", "bal_customer_crm": "double"}
    assert ("2", "9", 2.5) in rows(merged)


def test_repeated_and_hot_keys_match_a_full_outer_join(spark, rows):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("id"), F.col("id").alias("bal"))
    right = spark.range(60).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7).cast("int").alias("code"), F.col("id").alias("ok"))
    a, b = map_columns(left, MAPPING, "customer", "crm"), map_columns(right, MAPPING, "supplier", "erp")
    split, plain = consolidate(a, b, MAPPING), consolidate(a, b, MAPPING, trust_unique=True)
    assert rows(split) == rows(plain) == rows(consolidate(a, b, MAPPING, measure=True))
    assert "FullOuter" not in plan_of(split)


def test_a_unique_column_is_needed(spark, customer, supplier):
    with pytest.raises(ValueError, match="unique"):
        consolidate(customer, supplier, [Mapping("name", MAPPING[1].sources)])
    with pytest.raises(ValueError, match="unique"):
        propagate_changes(customer, customer.withColumn("operation", F.lit(1)), [], "customer", "crm")


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(
        [(1, "ANN", 9.0, U, 1), (2, "x", 0.0, D, 2), (4, "dan", 4.0, I, 3)],
        "id int, name string, bal double, operation int, seq bigint",
    ).withColumn("modified", F.lit("now"))


def test_replace_gives_way_to_the_changed_row(spark, rows, customer, supplier, changes):
    merged = consolidate(customer, supplier, MAPPING)
    after = propagate_changes(merged, changes, MAPPING, "customer", "crm")
    assert after.columns == merged.columns
    assert rows(after) == [
        (None, "nokey", 3.5, None), (None, "none", None, True), (1, "ANN", 9.0, None), (3, "cid", None, False), (4, "dan", 4.0, None),
    ]


def test_patch_keeps_what_other_members_feed(spark, rows, customer, supplier, changes):
    merged = consolidate(customer, supplier, MAPPING).unionByName(
        spark.createDataFrame([(5, None, 5.0, None)], "key int, name string, bal_customer_crm double, ok_supplier_erp boolean")
    )
    gone = spark.createDataFrame([(5, None, None, D, 4)], "id int, name string, bal double, operation int, seq bigint")
    after = propagate_changes(merged, changes.drop("modified").unionByName(gone), MAPPING, "customer", "crm", mode="patch")
    assert rows(after) == [
        (None, "nokey", 3.5, None), (None, "none", None, True), (1, "ANN", 9.0, None), (2, "bob", None, True),
        (3, "cid", None, False), (4, "dan", 4.0, None),
    ]


@pytest.mark.parametrize("mode", ["replace", "patch"])
def test_new_columns_reach_the_consolidated_table_and_repeats_are_harmless(spark, rows, customer, supplier, changes, mode):
    merged = consolidate(customer, supplier, MAPPING)
    wider = changes.withColumn("town", F.lit("Ulm")).withColumn("zip", F.lit(7))
    once = propagate_changes(merged, wider, MAPPING, "customer", "crm", mode=mode)
    assert once.columns == [*merged.columns, "city", "zip_customer_crm"]
    assert (4, "dan", 4.0, None, "Ulm", 7) in rows(once)
    assert rows(propagate_changes(once, wider, MAPPING, "customer", "crm", mode=mode)) == rows(once)


def test_many_changes_of_one_consolidated_key(spark, rows, customer):
    two = spark.createDataFrame([(1, "a", 1.0, U, 1), (1, "b", 2.0, U, 2)], "id int, name string, bal double, operation int, seq bigint")
    kept = propagate_changes(customer, two, MAPPING, "customer", "crm")
    assert rows(kept.where("key = 1"), "name") == [("a",), ("b",)]
    patched = propagate_changes(customer, two, MAPPING, "customer", "crm", mode="patch")
    assert rows(patched.where("key = 1"), "name") == [("b",)]


@pytest.mark.parametrize("seed,measure", [(1, False), (2, True)])
def test_propagation_equals_its_statement_row_by_row(spark, seed, measure):
    r = random.Random(seed)

    def maybe(v):
        return None if r.random() < 0.4 else v

    keys = [None, *range(12)]
    merged_rows = [(r.choice(keys), maybe("old"), maybe(1.0), maybe(True)) for _ in range(30)]
    events = [(r.choice(keys), maybe(f"n{s}"), maybe(float(s)), r.choice([I, U, D]), s) for s in range(40)]
    merged = spark.createDataFrame(merged_rows, "key int, name string, bal_customer_crm double, ok_supplier_erp boolean")
    changes = spark.createDataFrame(events, "id int, name string, bal double, operation int, seq bigint")
    newest = {e[0]: e for e in events}

    def found(mode, compact):
        df = propagate_changes(merged, changes, MAPPING, "customer", "crm", mode=mode, compact=compact, measure=measure)
        return sorted(map(str, (tuple(x) for x in df.collect())))

    replaced = [m for m in merged_rows if m[0] not in newest] + [(e[0], e[1], e[2], None) for e in newest.values() if e[3] != D]
    assert found("replace", "latest") == sorted(map(str, replaced))

    patched = []
    for key, name, bal, ok in merged_rows:
        event = newest.get(key)
        if event is None:
            patched.append((key, name, bal, ok))
        elif event[3] != D:
            patched.append((key, event[1], event[2], ok))
        elif (name, ok) != (None, None):
            patched.append((key, name, None, ok))
    present = {m[0] for m in merged_rows}
    patched += [(e[0], e[1], e[2], None) for e in newest.values() if e[3] != D and e[0] not in present]
    assert found("patch", None) == sorted(map(str, patched))


def definition(name, *members):
    return (name, [(i, t, a) for i, t, a in members], [])


def test_targets_match_table_and_alias_on_the_same_member(spark, rows):
    defs = spark.createDataFrame(
        [definition("m1", (1, "t", "a"), (2, "u", "b")), definition("m2", (1, "t", "b"), (2, "u", "a")), definition("m3")], MERGE_DEFINITION
    )
    assert rows(targets_of(defs, "t", "a"), "merge_table_name") == [("m1",)]


def test_new_members(spark, rows):
    old = spark.createDataFrame([definition("m1", (1, "t", "a"))], MERGE_DEFINITION)
    new = spark.createDataFrame([definition("m1", (1, "t", "a"), (2, "u", "b")), definition("m2", (1, "t", "a"))], MERGE_DEFINITION)
    assert rows(new_members(old, new), "merge_table_name", "table_id") == [("m1", 2), ("m2", 1)]


def test_mappings_from_metadata(spark):
    found = Mapping.from_metadata([{"colName": "key", "listCol": ["crm.customer.id"], "is_unique": 1}])
    assert found == [Mapping("key", ("crm.customer.id",), True)]


def test_keys_that_repeat_on_both_sides_are_refused(spark):
    mapping = [Mapping("key", ("a.t.id", "b.u.id"), unique=True)]
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n"), (None, "m")], "key int, v_t_a string")
    again = spark.createDataFrame([(1, "p"), (1, "q"), (None, "n"), (None, "m")], "key int, v_u_b string")
    once = again.where("key is null or v_u_b = 'p'")
    with pytest.raises(ValueError, match="repeat on both sides"):
        consolidate(twice, again, mapping, refuse_repeats=True)
    assert consolidate(twice, once, mapping, refuse_repeats=True).count() == 6
