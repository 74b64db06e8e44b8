"""Scalar functions offered to user queries."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

def percent_of(total: Column | str, part: Column | str) -> Column:
    """``part`` as a percentage of ``total``; 0 when ``total`` is 0."""
    total = F.col(total) if isinstance(total, str) else total
    part = F.col(part) if isinstance(part, str) else part
    total = total.cast("double")
    # Divides by NULL on the zero branch, so ANSI mode has nothing to raise on.
    return F.when(total == 0, F.lit(0.0)).otherwise(part.cast("double") / F.nullif(total, F.lit(0.0)) * 100)


def register_functions(spark: SparkSession, percent_name: str = "percent_recover") -> None:
    """Make ``percent_of`` callable from SQL as ``percent_name(confirm, recover)``.

    A SQL function body is inlined into the query plan, so no row leaves the JVM.
    Queries written for another name keep working when that name is passed.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {percent_name}(confirm DOUBLE, recover DOUBLE) RETURNS DOUBLE "
        "RETURN CASE WHEN confirm = 0 THEN 0D ELSE recover / nullif(confirm, 0D) * 100 END"
    )
