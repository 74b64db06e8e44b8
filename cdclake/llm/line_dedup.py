"""Line deduplication by pairs of line hashes.

A repeated run is two or more lines in a row that stand in the same order at an
earlier place, or one line of ``LONG_LINE`` words or more that does; earlier
means by document id and then by line. Its lines are deleted at every later
place; the first place keeps them.

Every two neighbouring lines are a window, keyed by both hashes in order, and a
long line is a window of its own. No position is left out as winnowing would;
windows that overlap join into longer runs. The first place of each match is the least of an
aggregate with a partial step, so a line that a third of all documents share
reaches the shuffle once a task.

Cases: a NULL text stays NULL and has no lines; an empty text has one blank line.
Blank lines belong to no run and end one, unless ``over_blank`` is set: then runs
are of the lines that are not blank, and blank ones within a run go with it. Rows with one id are ordered by a hash of their
text; equal rows are one place and keep or lose the same lines. A NULL id comes
first. Empty tables give no rows. Other columns pass through; names beginning
with ``__`` are for inner use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cdclake.llm.common import stored, table

LONG_LINE = 20
#: The bound of the pipeline, whose runs go on over blank lines.
SHORT_LINE = 8

KEY = ["anchor", "side", "other"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, long_line: int = LONG_LINE, over_blank: bool = False) -> DataFrame:
    """One row per window: the place of its first line, its number of lines, and its key.

    The key is the selected line's hash, where the selected line stands in the
    window (2: alone), and the other line's hash.
    """
    words = lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+"))
    hashed = F.transform(_lines(F.col("text")), lambda x, i: F.struct(
        i.alias("i"), F.xxhash64(x).alias("h"), words(x).alias("n")
    ))
    row = lambda i, lines, anchor, side, other: F.struct(
        i.alias("line"), lines.alias("lines"), anchor.alias("anchor"), side.alias("side"), other.alias("other")
    )
    lines = F.col("__lines")
    pair = F.zip_with(
        F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))),
        lambda a, b: F.when((a["n"] > 0) & (b["n"] > 0), row(
            a["i"], b["i"] - a["i"] + 1, F.least(a["h"], b["h"]), F.when(a["h"] <= b["h"], 0).otherwise(1), F.greatest(a["h"], b["h"])
        )),
    )
    alone = F.transform(lines, lambda a: F.when(
        a["n"] >= long_line, row(a["i"], F.lit(1), a["h"], F.lit(2), F.lit(0).cast("bigint"))
    ))
    return (
        docs.where("text is not null")
        .select(F.struct("doc_id", F.md5("text").alias("digest")).alias("doc"), (F.filter(hashed, lambda x: x["n"] > 0) if over_blank else hashed).alias("__lines"))
        .select("doc", F.explode(F.filter(F.concat(pair, alone), lambda x: x.isNotNull())).alias("__window"))
        .select("doc", "__window.*")
    )


def repeated_lines(docs: DataFrame, long_line: int = LONG_LINE, over_blank: bool = False) -> DataFrame:
    """``doc`` (id and digest of the text) and ``gone``, the numbers of its lines in later repeats."""
    found = stored(windows(docs, long_line, over_blank), "line-windows")
    place = F.struct("doc", "line")
    first = (
        found.groupBy(*KEY).agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    later = found.join(first, KEY).where(~place.eqNullSafe(F.col("first")))
    each = later.select("doc", F.explode(F.sequence("line", F.col("line") + F.col("lines") - 1)).alias("line"))
    return each.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def dedup_lines(docs: DataFrame, long_line: int = LONG_LINE, over_blank: bool = False) -> DataFrame:
    """``docs`` with the later repeats deleted from ``text``, and ``n_removed``, the number of deleted lines.

    ``n_chars``, where there is one, is counted anew.
    """
    gone = repeated_lines(docs, long_line, over_blank).select(
        F.col("doc.doc_id").alias("__id"), F.col("doc.digest").alias("__digest"), F.col("gone").alias("__gone")
    )
    joined = docs.drop("n_removed").join(
        gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.md5("text") == F.col("__digest")), "left"
    )
    kept = F.array_join(
        F.filter(_lines(F.col("text")), lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n"
    )
    changed = {"text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)}
    out = joined.withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("bigint")).withColumns(changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.drop("__id", "__digest", "__gone")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_removed", F.length("text").cast("bigint").alias("n_kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


ORACLE = rf"""
with lines as (
    select doc_id, md5(text) as digest, i - 1 as line, string_split(text, chr(10))[i] as body,
        len(regexp_extract_all(string_split(text, chr(10))[i], '[^\x20\x09-\x0D]+')) as words
    from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents where text is not null)
), windows as (
    select a.doc_id, a.digest, a.line, 2 as lines, a.body as body, b.body as next
    from lines a join lines b
        on a.doc_id is not distinct from b.doc_id and a.digest = b.digest and b.line = a.line + 1
    where a.words > 0 and b.words > 0
    union all
    select doc_id, digest, line, 1, body, null from lines where words >= {LONG_LINE}
), ranked as (
    select *, dense_rank() over (
        partition by lines, body, next order by doc_id nulls first, digest, line
    ) as place
    from windows
), gone as (
    select distinct doc_id, digest, line + unnest(range(lines)) as line from ranked where place > 1
), kept as (
    select l.doc_id, l.digest, count(g.line) as n_removed,
        coalesce(string_agg(l.body, chr(10) order by l.line) filter (where g.line is null), '') as text
    from lines l left join gone g
        on l.doc_id is not distinct from g.doc_id and l.digest = g.digest and l.line = g.line
    group by l.doc_id, l.digest
)
select d.doc_id, coalesce(k.n_removed, 0) as n_removed, length(k.text) as n_kept_chars, sha256(k.text) as kept_sha256
from documents d left join kept k on d.doc_id is not distinct from k.doc_id and md5(d.text) = k.digest
"""
