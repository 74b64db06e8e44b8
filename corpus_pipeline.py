"""A corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import DOCUMENTS, stored, table
from cdclake.llm.line_dedup import SHORT_LINE, dedup_lines
from cdclake.llm.mixing import mix_documents
from cdclake.llm.ngram_join import jaccard_components
from cdclake.llm.packing import pack
from cdclake.llm.quality_rules import quality_rules

#: Near-duplicates on word shingles: five words, a similarity of 0.8 or more.
SHINGLE, SIMILAR = 5, (80, 100)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    # A generator, not a filter: a pushed-down filter would count every text once per condition.
    return judged.select(F.inline(F.when(F.col("kept"), F.array(F.struct(*DOCUMENTS)))))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of line runs; ``n_chars`` is counted anew."""
    return dedup_lines(docs, SHORT_LINE, over_blank=True).select(*DOCUMENTS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id.

    A document without words is in no group and stays, as do rows without an id.
    Rows that share an id stay or go together; of equal rows one stays.
    """
    groups = jaccard_components(docs, SHINGLE, *SIMILAR)
    gone = groups.where("n_shingles > 0 and component_id < doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*DOCUMENTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(docs).select(*DOCUMENTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    from public_tokenizers import path

    return pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Word hashes and token ids have no DuckDB form; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
