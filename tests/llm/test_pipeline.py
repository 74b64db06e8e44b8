"""The pipeline's stages over awkward documents, and the registered queries with SQL forms."""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from cdclake.llm import common, quality_rules
from tests.llm.cases import documents
from tests.llm.test_text_operators import shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    docs = documents(spark).select(*common.DOCUMENTS)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(common.stored(stage(spark, kept[-1], sf), "stage"))
    for frame in kept[:-1]:
        assert frame.columns == common.DOCUMENTS
    good = quality_rules.quality_rules(docs, common.table(spark, sf, "labels")).where("kept")
    assert sorted(map(str, kept[1].collect())) == sorted(map(str, good.select(*common.DOCUMENTS).collect()))
    assert kept[2].count() == kept[1].count()
    before, after = kept[2].collect(), kept[3].collect()
    sets = [(r["doc_id"], shingles(r["text"], 5)) for r in after if r["doc_id"] is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            assert a == b or not (x and y) or 100 * len(x & y) < 80 * len(x | y)
    ids = {r["doc_id"] for r in after}
    for r in before:
        mine = shingles(r["text"], 5)
        if r["doc_id"] not in ids:
            assert any(
                o["doc_id"] is not None and o["doc_id"] < r["doc_id"] and 100 * len(mine & shingles(o["text"], 5)) >= 80 * len(mine | shingles(o["text"], 5))
                for o in before)
    assert {r["doc_id"] for r in kept[4].collect()} <= ids
    copies = collections.Counter(str(r) for r in kept[4].collect())
    assert max(copies.values(), default=0) <= 3
    pieces = kept[5].groupBy("sequence_id").sum("length").collect()
    assert pieces and all(0 < r[1] <= 2048 for r in pieces)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["op5_mix_sources", "op10_line_dedup"])
def test_sql_forms(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    cursor = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    found = contract.queries()[name](spark, SF)
    assert set(found.columns) == set(columns)
    assert sorted(map(str, cursor.fetchall())) == sorted(str(tuple(r)) for r in found.select(*columns).collect())


def test_every_corpus_query_is_registered():
    names = set(contract.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
