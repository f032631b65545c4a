"""Exact deduplication by deterministic block naming.

A text is cut into blocks of BLOCK bytes.  The distinct blocks are sorted and numbered, so equal blocks, and only
those, share a name.  Then adjacent pairs of names are numbered in the same way, level by level, until each text has
one name: two texts have the same (level, name) if and only if they are equal.

Scale: the text is shuffled once, already without the repeats of each task (partial aggregation), and sorted by its hash.
Occurrences find their block's name by that 64-bit hash; a hash that two different blocks share is found by a count
and its occurrences are matched by content instead, so names never collide.  Later levels move pairs of integers.
All levels join stored tables, so that adaptive execution can split a group of copies that holds a large part of all rows.

Names are numbered anew in each run: equal names mean equal texts within one run, whatever the number of partitions.

Nulls: a null text is an empty text; a null id stays as it is.  If ids repeat or are null, rows are told apart by numbers in a stored table.
An empty table gives an empty result.  Of a group the row with the largest id stays; among rows with that same id all
carry kept = true (keep_row names one of them).  Texts of any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, numbered, table

BLOCK = 2048


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def _number(distinct: DataFrame, *keys: str) -> DataFrame:
    """Sorted rank within the task plus the task's own range: the same rows always get the same numbers."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def identities(ws: Workspace, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc, n_bytes, sha, level, name) for the rows (doc, text) of docs; doc must be unique and not null."""
    data = F.col("text").cast("binary")
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / block).cast("int"))
    cut = docs.select("doc", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(data, i * block + 1, F.lit(block)))).alias("pos", "block"))
    cut = cut.select("doc", "pos", block_hash(F.col("block")).alias("h"), "block")
    names = ws.put("blocks", _number(cut.select("h", "block").distinct(), "h", "block").select("h", "name"))
    shared = names.groupBy("h").count().filter("count > 1").select("h")
    clash = ws.put("clash", shared)
    occ = cut.drop("block").join(names, "h").select("doc", "pos", "name")
    if not clash.isEmpty():
        alone = names.join(clash, "h", "left_anti")
        by_text = ws.put("by_text", _number(cut.join(clash, "h", "left_semi").select("h", "block").distinct(), "h", "block").withColumn("name", -1 - F.col("name")))
        occ = cut.drop("block").join(alone, "h").select("doc", "pos", "name").unionByName(cut.join(by_text, ["h", "block"]).select("doc", "pos", "name"))
    occ = ws.put("level0", occ)
    longest = docs.select(F.max(n)).first()[0] or 1
    done, level = [], 0
    while longest > 1:
        # a text whose blocks are one name is done; the others go on in pairs
        size = occ.groupBy("doc").agg(F.max("pos").alias("last"))
        done.append(size.filter("last = 0").select("doc").join(occ, "doc").select("doc", F.lit(level).alias("level"), "name"))
        more = occ.join(size.filter("last > 0").select("doc"), "doc")
        pair = (F.col("pos") / 2).cast("int")
        pairs = ws.put(f"pairs{level}", more.groupBy("doc", pair.alias("pos")).agg(F.min_by("name", "pos").alias("a"), F.when(F.count("*") > 1, F.max_by("name", "pos")).alias("b")))
        named = ws.put(f"names{level}", _number(pairs.select("a", "b").distinct(), "a", "b"))
        match = (pairs["a"] == named["a"]) & pairs["b"].eqNullSafe(named["b"])
        level += 1
        occ = ws.put(f"level{level}", pairs.join(named, match).select("doc", "pos", "name"))
        longest = (longest + 1) // 2
    out = occ.select("doc", F.lit(level).alias("level"), "name")
    for d in done:
        out = out.unionByName(d)
    return out


def exact_groups(docs: DataFrame, block: int = BLOCK, row: str | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    row: a column of unique integers; the result then has it too, with keep_row: the row of the largest id (a null one is least), of several
    the largest row.
    """
    ws = Workspace(docs.sparkSession, "exact")
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *([row] if row else []))
    src, plain = numbered(ws, src, row)
    rows = src.select(F.col("row").alias("doc"), "text")
    ids = ws.put("ids", identities(ws, rows, block))
    own = src.select("doc_id", F.col("row").alias("doc"), F.sha2("text", 256).alias("text_sha256"))
    full = ws.put("full", own.join(ids, "doc").select("doc_id", "doc", "text_sha256", "level", "name"))
    best = [] if plain else [F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), "doc")).alias("best")]
    groups = ws.put("groups", full.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), *best))
    ws.keep("full", "groups")
    kept = F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False)).alias("kept")
    more = [F.col("doc").alias(row), F.col("best.doc").alias("keep_row")] if row else []
    return full.join(groups, ["level", "name"]).select("doc_id", "keep_id", "group_size", kept, "text_sha256", *more)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
