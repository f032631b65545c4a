"""Rows that are let through, and attributes that are joined on: languages, key sets, readable cells, synonyms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import stages


def of_languages(rows: DataFrame, column: str, languages: Sequence[str]) -> DataFrame:
    """Rows whose language is listed, letter case aside; null is none of them.  No list lets all through."""
    return rows.filter(F.lower(column).isin([x.lower() for x in languages])) if languages else rows


def with_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a set that is itself a table: a semi join, broadcast only if the set is found small."""
    return rows.join(stages.small(stages.once(keys.select(key).filter(F.col(key).isNotNull()).distinct(), "keys")), key, "left_semi")


def json_cells(rows: DataFrame, cell: Column, *keep: str) -> DataFrame:
    """(keep, dim, value) of the numbers in a JSON object; null or broken text, and entries that are no numbers, give no row."""
    each = rows.select(*keep, F.explode(F.from_json(cell, "map<string,string>")).alias("dim", "text"))
    return each.select(*keep, "dim", F.col("text").try_cast("double").alias("value")).filter("value is not null")


def with_synonyms(baseline: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Baseline rows with the words of their dim (dim, synonyms), an empty list where there are none."""
    known = stages.small(stages.once(synonyms.select("dim", "synonyms"), "synonyms"))
    return baseline.drop("synonyms").join(known, "dim", "left").withColumn("synonyms", F.coalesce("synonyms", F.array().cast("array<string>")))
