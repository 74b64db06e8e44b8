"""Independent statements of the merge rules, to compare the operators with."""

from pyspark.sql import Window, functions as F


def literal_compaction(changes, key):
    """Compaction by its defining steps: lead, range anti-joins, newest per key and operation."""
    for last, dropped in ((3, None), (2, 1)):
        marks = (
            changes.where(F.col("operation") == last)
            .withColumn("next", F.lead("seq").over(Window.partitionBy(key).orderBy("seq")))
            .select(F.col(key).alias("m_key"), F.col("seq").alias("m_seq"), "next")
        )
        hit = (
            (F.col(key) == F.col("m_key"))
            & (F.col("seq") < F.col("m_seq"))
            & ((F.col("seq") > F.col("next")) | F.col("next").isNull())
        )
        if dropped is not None:
            hit = hit & (F.col("operation") == dropped)
        changes = changes.join(marks, hit, "left_anti")
    newest = F.max("seq").over(Window.partitionBy(key, "operation"))
    return changes.withColumn("newest", newest).where("seq = newest").drop("newest")


def replay(table, events):
    """A table after its events, one at a time: ``{key: row}`` with upserts and deletes."""
    state = dict(table)
    for event in sorted(events, key=lambda e: e["seq"]):
        if event["operation"] == 3:
            state.pop(event["id"], None)
        else:
            state[event["id"]] = event["v"]
    return state
