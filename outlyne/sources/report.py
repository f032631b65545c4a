"""A page about captioned clips: how many there are of each kind, then a section for each, clips with an error included.

Lines are made by all tasks and joined in order by `documents`, so neither the driver nor a task holds the page.  All texts are escaped, their line breaks
shown as such; a null text is empty, and a number that is null or not finite is shown as a question mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import emphasise, html_escape
from . import documents, stages

STYLE = "body{font:15px sans-serif;max-width:60em;margin:2em auto}section{border:1px solid #bbb;padding:.6em 1em;margin:1em 0}.burst{color:#a40}.off{color:#888}.error{background:#fee}"


def shown(text: Column) -> Column:
    return F.regexp_replace(html_escape(F.coalesce(text, F.lit(""))), r"\r\n|\r|\n", "<br>")


def number(value: Column, places: int) -> Column:
    """Rounded half up, with all its places."""
    return F.coalesce(value.try_cast(f"decimal(20,{places})").cast("string"), F.lit("?"))


def _items(rows: Column, item) -> Column:
    return F.concat(F.lit("<ul>"), F.array_join(F.transform(rows, item), "", "<li></li>"), F.lit("</ul>"))


def _sentence(s: Column) -> Column:
    told = F.when(s["burst"].isNull(), '<span class="off">no burst</span>').otherwise(F.concat(F.lit('<span class="burst">'), shown(s["burst_caption"]), F.lit("</span>")))
    return F.concat(F.lit("<li>"), shown(s["text"]), F.lit(" <i>"), shown(s["caption"]), F.lit("</i> "), told, F.lit("</li>"))


def _span(b: Column) -> Column:
    time = F.concat(number(b["start"], 1), F.lit("–"), number(b["end"], 1), F.lit(" s: "))
    named = F.concat(shown(b["label"]), F.lit(" ("), number(b["prob"], 2), F.lit(")"))
    left_out = F.when(b["label"].isNull(), F.concat(F.lit("left out, no burst by "), number(b["p_noburst"], 2))).otherwise(F.concat(named, F.lit(" left out, too short")))
    return F.concat(F.lit("<li>"), time, F.when(b["kept"], F.concat(F.lit('<span class="burst">'), named, F.lit("</span>"))).otherwise(F.concat(F.lit('<span class="off">'), left_out, F.lit("</span>"))), F.lit("</li>"))


def section(kind: Column) -> Column:
    """The section of a row of `flow.captions`."""
    title = F.concat(F.lit("<h3>"), shown(F.col("clip").cast("string")), F.lit(" <small>"), shown(kind))
    bad = F.concat(F.lit('<section class="error">'), title, F.lit("</small></h3><p>Error: "), shown(F.col("error")), F.lit("</p></section>"))
    about = F.concat(F.lit(", "), number(F.col("dur"), 1), F.lit(" s, "), F.coalesce(F.col("n_words"), F.lit(0)).cast("string"), F.lit(" words</small></h3>"))
    inline = emphasise(shown(F.col("inline")))
    parts = [
        F.lit("<section>"), title, about, F.lit("<p>"), shown(F.col("global_caption")), F.lit("</p>"),
        F.lit("<h4>In place</h4><p>"), F.when(inline == "", "nothing said, no bursts").otherwise(inline), F.lit("</p>"), _items(F.col("bursts"), _span),
        F.lit("<h4>By sentence</h4>"), _items(F.col("sentences"), _sentence), F.lit("</section>"),
    ]
    return F.when(F.col("error").isNotNull(), bad).otherwise(F.concat(*parts))


def lines(clips: DataFrame, kind: Column) -> DataFrame:
    """(part, kind, clip, line): the counts of each kind, of good clips and of errors, then the sections."""
    one = clips.withColumn("_kind", F.coalesce(kind, F.lit("")))
    failed = F.count_if(F.col("error").isNotNull())
    said = F.concat(F.lit("<p>"), shown(F.col("_kind")), F.lit(": "), (F.col("n") - F.col("bad")).cast("string"), F.lit(" clips, "), F.col("bad").cast("string"), F.lit(" errors, "), F.col("spans").cast("string"), F.lit(" spans</p>"))
    counts = one.groupBy("_kind").agg(F.count("*").alias("n"), failed.alias("bad"), F.coalesce(F.sum("n_spans"), F.lit(0)).alias("spans"))
    id_ = F.col("clip").cast("string").alias("clip")
    head = counts.select(F.lit(0).alias("part"), F.col("_kind").alias("kind"), F.lit("").alias("clip"), said.alias("line"))
    return head.unionByName(one.select(F.lit(1).alias("part"), F.col("_kind").alias("kind"), id_, section(F.col("_kind")).alias("line")))


def page(clips: DataFrame, path: str, title: str, kind: Column, notes: str = "") -> int:
    """Writes the page, a line for each count and each clip; returns how many of these lines there are.

    clips: rows of `flow.captions`; kind: a text column of them, null as the empty text; notes: escaped text below the title.
    """
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    head = f'<!doctype html><html><head><meta charset="utf-8"><title>{esc(title)}</title><style>{STYLE}</style></head><body><h1>{esc(title)}</h1><p>{esc(notes)}</p>\n'
    rows = stages.once(lines(clips, kind), "page")
    return documents.ordered(rows, path, F.col("line"), ["part", "kind", "clip"], head, "\n</body></html>\n", "\n")
