import json

import pytest
from pyspark.sql import Observation, functions as F, types as T

from cdclake.model import APPLY_REQUEST, CHANGE, TableRef, merge_table_path
from cdclake.operators.envelope import (
    changes_schema, decode_changes, decode_envelope, decode_requests, encode_changes, typed_entries,
)
from cdclake.sources.log import change_messages

SCHEMA = '["id:bigint","name:varchar(20)","amount:decimal(10,2)"]'


def log(spark, *events, schema=SCHEMA):
    """Events as ``(id, operation, image)`` or with a schema text of their own as fourth part."""
    return spark.createDataFrame(
        [(e[0], "h", "1", "db", "t", e[3] if len(e) > 3 else schema, e[2], e[1], 0) for e in events], CHANGE
    )


def test_typed_and_text_images_decode_alike(spark, rows):
    changes = log(spark, (1, 1, '{"id":"1","name":"x","amount":"2.50"}'), (2, 2, '{"id":2,"name":"y","amount":3.5}'))
    decoded, bad = decode_changes(changes, "mysql", modified="now")
    assert [str(v) for r in rows(decoded) for v in r] == ["1", "x", "2.50", "1", "1", "now", "2", "y", "3.50", "2", "2", "now"]
    assert rows(bad) == []


def test_undecodable_events_are_set_aside_and_none_is_lost(spark, rows):
    changes = log(
        spark, (1, 1, None), (2, 1, '{"id":"2"'), (3, 9, '{"id":"3"}'), (None, 1, '{"id":"4"}'), (5, None, '{"id":"5"}'),
        (6, 1, "[]"), (7, 3, '{"id":"7"}'),
    )
    good, bad = decode_changes(changes, "mysql")
    assert rows(good, "id", "seq") == [(7, 7)]
    assert rows(bad, "id", "reason") == [
        (None, "no position"), (1, "no row image"), (2, "broken row image"), (3, "unknown operation"),
        (5, "unknown operation"), (6, "broken row image"),
    ]


def test_a_value_that_does_not_fit_its_type_is_null_and_reported(spark, rows):
    good, bad = decode_changes(log(spark, (1, 1, '{"id":"abc","name":"x","amount":"many"}')), "mysql")
    assert rows(good, "id", "name", "amount") == [(None, "x", None)]
    assert rows(bad, "id", "reason") == [(1, "values that do not fit: id, amount")]


def test_nested_values_become_text(spark, rows):
    changes = log(spark, (1, 1, '{"id":1,"tags":{"a":2}}'), schema='["id:bigint","tags:jsonb"]')
    assert rows(decode_changes(changes, "postgresql")[0], "id", "tags") == [(1, '{"a":2}')]


def test_quotes_and_nulls_survive_encoding(spark, rows):
    source = TableRef("mysql", "h", "1", "db", "t")
    df = spark.createDataFrame([(1, 'say "hi"\n', None), (2, "ü,\\", 0.1)], "id bigint, name string, v double")
    changes = encode_changes(df, 1, source=source, seq=F.col("id"), created=F.lit(5))
    good, bad = decode_changes(changes, "mysql")
    assert rows(good, "id", "name", "v") == rows(df)
    assert rows(bad) == []


def test_timestamps_survive_encoding_to_the_microsecond(spark, rows):
    df = spark.sql("select 1L id, timestamp_ntz '2024-01-02 03:04:05.678901' at")
    changes = encode_changes(df, 1, source=TableRef("mysql", "h", "1", "db", "t"), seq=F.col("id"), created=F.lit(5))
    good, _ = decode_changes(changes, "mysql")
    assert str(good.select(F.col("at").cast("string")).first()[0]) == "2024-01-02 03:04:05.678901"


@pytest.mark.parametrize("key", ["userId", "userid", "USERID"])
def test_images_may_spell_columns_in_another_case(spark, rows, key):
    changes = log(spark, (1, 1, json.dumps({key: "7"})), schema='["userId:bigint"]')
    good, _ = decode_changes(changes, "postgresql")
    assert good.columns[0].lower() == "userid"
    assert rows(good, "userid") == [(7,)]


def test_schema_is_the_union_of_the_batch_and_the_newest_type_wins(spark):
    changes = log(
        spark,
        (1, 1, '{"id":"1"}', '["id:int","a:int"]'),
        (3, 1, '{"id":"1"}', '["id:bigint","z:date"]'),
        (2, 1, '{"id":"1"}', '["ID:int"]'),
        (4, 1, '{"id":"1"}', "not a list"),
        (5, 1, '{"id":"1"}', None),
    )
    found = dict(changes_schema(changes, "mysql"))
    assert found == {"id": T.LongType(), "a": T.IntegerType(), "z": T.DateType()}


def test_unknown_types_are_reported(spark, rows):
    changes = log(spark, (1, 1, '{"g":"POINT(1 1)"}', '["g:geometry","n:int(11) unsigned"]'))
    assert rows(typed_entries(changes, "mysql"), "name", "spark_type", "known") == [("g", "string", False), ("n", "bigint", True)]
    assert rows(decode_changes(changes, "mysql")[0], "g", "n") == [("POINT(1 1)", None)]


def test_values_that_do_not_fit_are_named(spark, rows):
    schema = '["id:int","n:int","d:date","t:text"]'
    changes = log(
        spark,
        (1, 1, '{"id":"1","n":"2","d":"2024-01-02","t":"x"}'),
        (2, 1, '{"id":"2","n":"","d":"2024-13-02","t":""}'),
        (3, 1, '{"id":"3","n":"99999999999","d":null}'),
        (4, 9, '{"id":"x","n":"y"}'),
        (5, 1, '{"id":"5"}'),
        schema=schema,
    )
    seen = Observation()
    good, rejected = decode_changes(changes, "mysql", observation=seen)
    assert rows(good, "id", "n", "t") == [(1, 2, "x"), (2, None, ""), (3, None, None), (5, None, None)]
    assert seen.get == {"undecoded": 1, "unfit": 2}
    assert rows(rejected, "id", "reason") == [
        (2, "values that do not fit: n, d"), (3, "values that do not fit: n"), (4, "unknown operation"),
    ]
    assert rejected.columns == [*changes.columns, "reason"]


def test_columns_may_not_clash_with_event_columns(spark):
    changes = log(spark, (1, 1, '{"seq":"1"}'), schema='["seq:int"]')
    with pytest.raises(ValueError, match="clash"):
        decode_changes(changes, "mysql")
    good, _ = decode_changes(changes, "mysql", seq="position")
    assert good.columns == ["seq", "operation", "position"]


def test_messages_name_their_table_by_their_own_columns(spark, rows):
    changes = log(spark, (1, 1, "{}")).unionByName(log(spark, (2, 1, "{}")).withColumn("table_name", F.lit("Other")))
    messages = change_messages(changes)
    assert rows(messages, "topic", "key") == [("cdc-h-1-db-other", "h-1-db-other"), ("cdc-h-1-db-t", "h-1-db-t")]
    back = decode_envelope(messages)
    assert rows(back, "table_key", "id", "table_name") == [("cdc-h-1-db-other", 2, "Other"), ("cdc-h-1-db-t", 1, "t")]
    assert rows(back.select(*changes.columns)) == rows(changes)


def test_requests_are_split_by_topic_and_deduplicated(spark, rows):
    apply = json.dumps({"server_host": "h", "port": "1", "database": "db", "table": "T", "latest_offset": 7})
    merge = json.dumps({"host": "h", "mergeTable": "m", "jobID": 3})
    raw = spark.createDataFrame([("a", apply), ("a", apply), ("b", merge)], "topic string, value string")
    applied = decode_requests(raw, "apply", topic="a")
    assert applied.columns == [*APPLY_REQUEST.fieldNames(), "topic_cdc"]
    assert rows(applied, "topic_cdc", "latest_offset") == [("cdc-h-1-db-t", 7)]
    assert rows(decode_requests(raw, "merge", topic="b"), "mergeTable", "jobID") == [("m", 3)]


def test_table_paths():
    assert TableRef("mysql", "h", "1", "db", "t").path() == "/user/mysql/h/1/db/t"
    assert TableRef("oracle", "h", "1", "db", "t", owner="o").path("/lake/") == "/lake/oracle/h/1/o/t"
    assert TableRef("mysql", "h", "1", "db", "Orders").key == "cdc-h-1-db-orders"
    assert merge_table_path("party") == "/user/merge_request/party"
