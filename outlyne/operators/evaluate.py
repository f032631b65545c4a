"""Agreement of two ordinal raters, detection counts, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agreement(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """n, mae, sign_agree (three signs) over rows that have both."""
    r = rows.select(a.cast("double").alias("a"), b.cast("double").alias("b")).filter("a is not null and b is not null")
    return r.agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("a") - F.col("b"))), 4).alias("mae"), F.count_if(F.signum("a") == F.signum("b")).alias("sign_agree"))


def share(rows: DataFrame, hit: Column, *by: str) -> DataFrame:
    """n and hits, for each group."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.coalesce(hit, F.lit(False))).alias("hits"))


def span_counts(spans: DataFrame, *by: str) -> DataFrame:
    """Spans in all, with a label that is kept, and discarded."""
    return spans.groupBy(*by).agg(F.count("*").alias("n_spans"), F.count_if("kept").alias("n_kept"), F.count_if(F.col("label").isNotNull() & ~F.col("kept")).alias("n_gated"), F.count_if(F.col("label").isNull()).alias("n_no_burst"))


def votes(rows: DataFrame, choice: str) -> DataFrame:
    return rows.groupBy(F.col(choice).alias("choice")).agg(F.count("*").alias("n"))
