"""Tables kept as versions: what a merge writes, what readers see, what a failure leaves."""

import random

import pytest
from pyspark.sql import functions as F

from cdclake.model import Mapping
from cdclake.operators.apply import apply_changes
from cdclake.operators.consolidate import map_columns, propagate_changes
from cdclake.operators.versioned import apply_to_versions, merge_versions, propagate_versions, with_before_images
from cdclake.plans.query import run_query
from cdclake.sources import versions as vs

I, U, D = 1, 2, 3
TARGET = "id int, p string, v string"
CHANGES = "id int, p string, v string, operation int, seq bigint"


def frame(spark, *rows, ddl=TARGET):
    return spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def started(spark, path, *rows, files=1, partition_by=""):
    df = frame(spark, *rows).repartitionByRange(files, "id") if files > 1 else frame(spark, *rows).coalesce(1)
    vs.start_versions(df, path, partition_by)
    return path


def names(spark, path, number=None):
    return set(vs.table_version(spark, path, number).files)


@pytest.mark.parametrize("partition_by", ["", "p"])
def test_one_changed_key_rewrites_its_files_alone(spark, rows, path, partition_by):
    started(spark, path, *[(i, "ab"[i % 2], "x") for i in range(40)], files=4, partition_by=partition_by)
    before = names(spark, path)
    holder = {r[0] for r in spark.read.parquet(*[f"{path}/data/{f}" for f in before]).where("id = 7").select(vs.file_name()).collect()}
    merged = apply_to_versions(spark, path, frame(spark, (7, "b", "new", U, 1), ddl=CHANGES), "id", partition_by)
    after = names(spark, path)
    assert len(holder) == 1 and before - after == holder and after - before
    assert rows(merged.where("id = 7"), "id", "p", "v") == [(7, "b", "new")] and merged.count() == 40
    # Nothing was moved: the files of the old version are still where it names them.
    assert vs.read_table(spark, path, 1).where("v = 'new'").count() == 0 and vs.read_table(spark, path, 1).count() == 40


def test_a_reader_during_a_write_sees_its_version(spark, path):
    started(spark, path, *[(i, "a", "x") for i in range(10)], files=2)
    reader = vs.read_table(spark, path)
    apply_to_versions(spark, path, frame(spark, *[(i, "a", "y", U, i) for i in range(10)], ddl=CHANGES), "id")
    assert reader.where("v = 'x'").count() == 10
    assert vs.read_table(spark, path).where("v = 'y'").count() == 10


@pytest.mark.parametrize("partition_by", ["", "p"])
def test_a_new_column_rewrites_nothing(spark, rows, path, partition_by):
    started(spark, path, (1, "a", "x"), (2, "b", "y"), (3, "c", "z"), files=3, partition_by=partition_by)
    before = names(spark, path)
    log = frame(spark, (4, "a", "n", 7, I, 1), ddl="id int, P string, v string, zz int, operation int, seq bigint")
    merged = apply_to_versions(spark, path, log, "id", partition_by)
    assert before <= names(spark, path)
    assert merged.columns == ["id", "p", "v", "zz"]
    assert rows(merged) == [(1, "a", "x", None), (2, "b", "y", None), (3, "c", "z", None), (4, "a", "n", 7)]
    assert [v.schema.names for v in vs.history(spark, path)] == [["id", "p", "v"], ["id", "p", "v", "zz"]]


def test_only_a_type_conflict_rewrites_the_table(spark, rows, path):
    started(spark, path, (1, "a", "x"), (2, "b", "y"), files=2)
    before = names(spark, path)
    log = frame(spark, ("3", "a", "n", I, 1), ddl="id string, p string, v string, operation int, seq bigint")
    merged = apply_to_versions(spark, path, log, "id")
    assert not before & names(spark, path)
    assert rows(merged) == [("1", "a", "x"), ("2", "b", "y"), ("3", "a", "n")]
    again = apply_to_versions(spark, path, frame(spark, ("1", "a", None, D, 2), ddl="id string, p string, v string, operation int, seq bigint"), "id")
    assert rows(again) == [("2", "b", "y"), ("3", "a", "n")]


def random_batches(seed, batches=4, size=60):
    r, s, out = random.Random(seed), 0, []
    for _ in range(batches):
        log = []
        for _ in range(size):
            s += 1
            log.append((r.choice([None, 0, r.randrange(30)]), f"p{r.randrange(3)}", f"v{s}", r.choice([I, U, U, D]), s))
        out.append(log)
    return out


@pytest.mark.parametrize("partition_by,few", [("", True), ("p", True), ("p", False)])
def test_equals_apply_changes_and_repeats_safely(spark, rows, path, partition_by, few, monkeypatch):
    if not few:
        monkeypatch.setattr("cdclake.operators.versioned.broadcast_if_small", lambda df: (df, False))
    start = [(i, f"p{i % 3}", "start") for i in range(12)] + [(None, "p0", "none"), (3, "p1", "twice")]
    started(spark, path, *start, files=3, partition_by=partition_by)
    expected = frame(spark, *start)
    for log in random_batches(9):
        changes = frame(spark, *log, ddl=CHANGES)
        expected = spark.createDataFrame(apply_changes(expected, changes, "id").collect(), TARGET)
        for _ in range(2):
            merged = apply_to_versions(spark, path, changes, "id", partition_by)
        assert rows(merged, "id", "p", "v") == rows(expected)


def test_an_absent_table_is_started_and_can_be_emptied(spark, rows, path):
    merged = apply_to_versions(spark, path, frame(spark, (1, "007", "x", I, 1), (2, "8", "y", I, 2), ddl=CHANGES), "id", "p")
    assert rows(merged, "id", "p", "v") == [(1, "007", "x"), (2, "8", "y")]
    gone = frame(spark, (1, None, None, D, 3), (2, None, None, D, 4), ddl=CHANGES)
    assert apply_to_versions(spark, path, gone, "id", "p").count() == 0
    assert rows(apply_to_versions(spark, path, frame(spark, (5, "a b/c%", "z", I, 5), ddl=CHANGES), "id", "p"), "id", "p") == [(5, "a b/c%")]
    assert rows(apply_to_versions(spark, path, frame(spark, (5, "a b/c%", "w", U, 6), ddl=CHANGES), "id", "p"), "v") == [("w",)]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["write_files", "_write_text", "_move"])
def test_a_failure_leaves_the_last_version(spark, rows, path, monkeypatch, step):
    started(spark, path, (1, "a", "x"), (2, "b", "y"), files=2)
    log = frame(spark, (1, "a", "x2", U, 1), (3, "c", "z", I, 2), ddl=CHANGES)

    def fail(*args, **kwargs):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(f"cdclake.operators.versioned.{step}" if step == "write_files" else f"cdclake.sources.versions.{step}", fail)
        with pytest.raises(Crash):
            apply_to_versions(spark, path, log, "id")
    assert rows(vs.read_table(spark, path)) == [(1, "a", "x"), (2, "b", "y")]
    assert rows(apply_to_versions(spark, path, log, "id")) == [(1, "a", "x2"), (2, "b", "y"), (3, "c", "z")]


def test_two_writers_of_one_version(spark, rows, path):
    started(spark, path, (1, "a", "x"))
    version = vs.table_version(spark, path)
    added = vs.write_files(frame(spark, (2, "b", "y")), path)
    vs.commit(spark, path, version, version.schema, [], (), added)
    with pytest.raises(RuntimeError, match="another writer"):
        vs.commit(spark, path, version, version.schema, [], (), {})
    assert rows(vs.read_table(spark, path)) == [(1, "a", "x"), (2, "b", "y")]


def test_small_files_are_packed(spark, path):
    started(spark, path, *[(i, "ab"[i % 2], "x") for i in range(4)], partition_by="p")
    for i in range(14):
        merged = apply_to_versions(
            spark, path, frame(spark, (100 + i, "a", f"n{i}", I, i), ddl=CHANGES), "id", "p", most_small_files=3
        )
        version = vs.table_version(spark, path)
        assert vs.small_files(version) <= 3
    assert merged.count() == 18 and merged.where("p = 'a'").count() == 16


def test_packing_of_files():
    sizes = {"a": 60, "b": 50, "c": 40, "d": 30, "e": 20, "f": 100}
    groups = vs.pack_files(sizes, 100)
    assert sorted(map(sorted, groups)) == [["a", "c"], ["b", "d", "e"]]
    assert vs.pack_files({"a": 1}, 100) == []


def test_unreferenced_files_go(spark, rows, path):
    started(spark, path, *[(i, "a", "x") for i in range(4)], files=2)
    for k in range(3):
        apply_to_versions(spark, path, frame(spark, (1, "a", f"y{k}", U, k), ddl=CHANGES), "id")
    vs.write_files(frame(spark, (9, "z", "never")), path)
    assert vs.remove_unreferenced(spark, path, keep=1) > 0
    assert vs._list_files(spark, f"{path}/data").keys() == names(spark, path)
    assert rows(vs.read_table(spark, path).where("id = 1")) == [(1, "a", "y2")]
    assert vs.version_numbers(spark, path) == [4]


def test_queries_read_versions_by_path(spark, rows, path):
    started(spark, path, (1, "a", "x"), (2, "b", "y"))
    apply_to_versions(spark, path, frame(spark, (1, "a", None, D, 1), ddl=CHANGES), "id")
    assert rows(run_query(spark, "select id from :crm.t:", {"crm.t": path})) == [(2,)]


# --- consolidated tables ---

MAPPING = [Mapping("key", ("crm.t.code", "erp.s.code"), unique=True), Mapping("name", ("crm.t.v", "erp.s.w"))]


def party(spark):
    rows = [(c, f"n{c}", f"o{c}", c * 1.0) for c in range(1, 31)]
    return spark.createDataFrame(rows, "key int, name string, id_t_crm string, own_s_erp double")


@pytest.mark.parametrize("mode", ["replace", "patch"])
@pytest.mark.parametrize("partition_by", ["", "id_t_crm"])
def test_propagation_equals_that_over_the_whole_table(spark, rows, path, mode, partition_by):
    whole = party(spark).withColumn("id_t_crm", F.col("key").cast("string").substr(1, 1))
    vs.start_versions(whole.repartitionByRange(5, "key"), path, partition_by)
    before = names(spark, path)
    delta = frame(spark, (3, "3", "new", U, 1), (4, "4", None, D, 2), (99, "9", "added", I, 3),
                  ddl="code int, id string, v string, operation int, seq bigint")
    merged = propagate_versions(spark, path, delta, MAPPING, "t", "crm", mode, partition_by)
    expected = propagate_changes(whole, delta, MAPPING, "t", "crm", mode)
    assert rows(merged, *expected.columns) == rows(expected)
    assert before & names(spark, path)


def test_propagation_starts_an_absent_table(spark, rows, path):
    delta = frame(spark, (3, "x", U, 1), (4, None, D, 2), ddl="code int, v string, operation int, seq bigint")
    assert rows(propagate_versions(spark, path, delta, MAPPING, "t", "crm")) == [(3, "x")]


@pytest.mark.parametrize("mode", ["replace", "patch"])
def test_a_changed_unique_value_leaves_no_row_behind(spark, rows, mode):
    """Ids 1 and 2 change places, 3 moves to a new value, 4 goes with an image that lacks the value."""
    copy = spark.createDataFrame([(i, i * 10, f"v{i}") for i in range(1, 6)], "id int, code int, v string")
    mapping = [MAPPING[0], Mapping("name", ("crm.t.v",))]
    merged = map_columns(copy, mapping, "t", "crm")
    delta = spark.createDataFrame(
        [(1, 20, "a", U, 1), (2, 10, "b", U, 2), (3, 77, "c", U, 3), (4, None, None, D, 4)],
        "id int, code int, v string, operation int, seq bigint",
    )
    full = with_before_images(delta, copy, "id", mapping, "t", "crm")
    assert rows(full.where("seq < 0"), "code", "operation") == [(30, D), (40, D)]
    found = propagate_changes(merged, full, mapping, "t", "crm", mode)
    assert rows(found, "key", "name") == [(10, "b"), (20, "a"), (50, "v5"), (77, "c")]


def test_before_images_of_the_key_itself(spark):
    copy = spark.createDataFrame([(1, "x")], "code int, v string")
    delta = spark.createDataFrame([(1, "y", U, 1)], "code int, v string, operation int, seq bigint")
    assert with_before_images(delta, copy, "code", MAPPING, "t", "crm") is delta


def test_a_stored_delta_may_be_merged_twice(spark, rows, path):
    started(spark, path, (1, "a", "x"))
    delta = frame(spark, (1, "a", "y", U, 1), ddl=CHANGES)
    for _ in range(2):
        merged = merge_versions(spark, path, delta, "id")
    assert rows(merged) == [(1, "a", "y")]
