"""Document fingerprints: bottom-k sketches of word shingle hashes, by SQL functions only.

A sketch is the sorted list of the K smallest distinct 48-bit hashes of a text's five-word shingles; the word list is padded in
front, so a text of few words has shingles too.  Sketches of shingle sets merge into the sketch of their union (the K smallest of
both; a text cut in two is not such a union, since shingles span the cut), and give estimates of resemblance (share of common hashes among the K smallest of both), of containment
and of the number of distinct shingles (from the K-th smallest hash).  Up to K distinct shingles all three are exact.

Scale: a text's sketch is computed where the text is read; no shingle is shuffled.  The `next` document of the query is found in
ranges of ids: one shuffle by range, and each range also gets a copy of the next range's first row.  Ranges hold 4000 rows each until there
are 4096, and then grow; rows with null ids are one range, and so are rows with one id.  A range is sorted by one task, which may spill.

Nulls: a null text is empty: no shingles, sketch of no hashes.  Two empty sketches have likeness 1, an empty and a filled one 0.
Rows of equal id are ordered by text; null ids come last.  One row is its own next document.  An empty table gives an empty
result.  Texts of any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, table

K = 64
WIDTH = 5
RANGE_ROWS, RANGES = 4000, 4096
DIGITS = 12


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The sketch of a text as a sorted array of longs."""
    words = F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    pad = F.array(*[F.lit(0).cast("long") for _ in range(width - 1)])
    shingle = lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - width), lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(p, i + j) for j in range(width)]), 64 - 4 * DIGITS))
    every = _let(F.concat(pad, hashes), lambda p: F.when(F.size(p) < width, F.array().cast("array<bigint>")).otherwise(shingle(p)))
    return F.slice(F.sort_array(F.array_distinct(every)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, column: str = "sketch", k: int = K) -> DataFrame:
    """(key, column): the sketch of each whole from the sketches of its parts, however many they are: no task holds more than k hashes of a key."""
    hashes = parts.select(key, F.explode(column).alias("h")).distinct()
    least = hashes.withColumn("rk", F.row_number().over(Window.partitionBy(key).orderBy("h"))).filter(F.col("rk") <= k)
    some = least.groupBy(key).agg(F.array_sort(F.collect_list("h")).alias(column))
    none = parts.select(key).distinct().join(some, key, "left")
    return none.select(key, F.coalesce(column, F.array().cast("array<bigint>")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    whole = F.when((F.size(a) < k) & (F.size(b) < k), F.array_union(a, b)).otherwise(merge(a, b, k))
    both = F.array_intersect(a, b)
    return _let(whole, lambda w: F.when(F.size(w) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(w, both)) / F.size(w)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) * F.lit(float(16**DIGITS)) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    common = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0")), "")


def in_ranges(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text) with `at`, their range in descending doc_id, and copies (`copy`) of the first row of the
    range that follows; the first range follows the last.  So a row's next row is in its own range."""
    ranges = max(1, min(RANGES, docs.count() // RANGE_ROWS))
    cuts = []
    if ranges > 1:
        cuts = sorted(set(docs.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 50_000)).first()[0] or []))
    place = F.lit(len(cuts)) - F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0)
    rows = docs.withColumn("at", F.coalesce(F.when(F.col("doc_id").isNotNull(), place), F.lit(len(cuts) + 1)))
    line = Window.orderBy("at")  # over the ranges
    tops = rows.groupBy("at").agg(F.max("doc_id").alias("top")).withColumn("to", F.coalesce(F.lag("at").over(line), F.max("at").over(Window.partitionBy())))
    head = rows.join(F.broadcast(tops), "at").filter(F.col("doc_id").eqNullSafe(F.col("top")))
    head = head.groupBy(F.col("to").alias("at"), "doc_id").agg(F.min("text").alias("text"))  # among equal ids the least text
    return rows.withColumn("copy", F.lit(False)).unionByName(head.withColumn("copy", F.lit(True)))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """The result of the query for rows (doc_id, text)."""
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = in_ranges(src).withColumn("fp", sketch(F.col("text"), k))
    order = Window.partitionBy("at").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    rows = both.withColumn("after", F.lead(F.struct("text", "fp")).over(order)).filter("not copy")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("after.text"), F.lit(1), half))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", F.col("after.fp").alias("nfp"), edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "nfp", sketch(F.col("edited"), k).alias("efp"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("efp")).alias("edited_fingerprint"), resemblance(F.col("fp"), F.col("efp"), k).alias("near_edited"), resemblance(F.col("fp"), F.col("nfp"), k).alias("near_next"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
