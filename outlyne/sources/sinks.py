"""Writers: stage tables, result lines, reports.  Single documents and files for each row are written by `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scoring import emphasise, html_escape


def stage(df: DataFrame, path: str) -> DataFrame:
    """Writes a stage as Parquet and returns the reread table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def results(df: DataFrame, path: str) -> int:
    """One JSON object a line; returns how many, as counted while they were written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def cards(df: DataFrame, key: str, text: str, error: str | None = None) -> DataFrame:
    """(key, html): a card for each row; errors show as such."""
    body = F.concat(F.lit('<div class="card"><b>'), html_escape(F.col(key).cast("string")), F.lit("</b> "), emphasise(html_escape(F.coalesce(text, F.lit("")))), F.lit("</div>"))
    if error:
        body = F.when(F.col(error).isNotNull(), F.concat(F.lit('<div class="card"><b>'), html_escape(F.col(key).cast("string")), F.lit("</b> — ERROR: "), html_escape(F.col(error)), F.lit("</div>"))).otherwise(body)
    return df.select(key, body.alias("html"))


def folder_each(df: DataFrame, path: str, key: str) -> None:
    """A folder of JSON lines for each key."""
    df.write.mode("overwrite").partitionBy(key).json(path)
