"""Fill-in-the-middle arrangement of texts, by SQL functions only.

A text is cut into units (runs of ASCII letters, else single code points) by regexp_extract_all.  Two groups of hex digits of
sha256("seed:id"), read by conv, place the two cuts among the units, two more choose the form; slice and array_join build prefix,
middle and suffix.  The arrangements are

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text itself

restore() finds the sentinels again and rebuilds the text from output and form.  It is exact: a text that contains a sentinel stays plain, and a
sentinel can't arise at a seam, since none begins with what another ends with.

Scale: every row is made where it is read; nothing is shuffled, so no key, source or group of copies can be hot, and a lost task reads
its rows again.  The draw depends on the seed and the id only, so a rerun gives the same rows at any number of partitions.  A
text is read whole; its units are one array of its task, some 40 bytes each, so a text must be well below the 2 GB of a row.

Nulls: a null text is empty, hence plain with no units; a null id draws like the empty text.  Rows of one id draw the same cuts, each among its own
units.  Repeated rows give repeated rows, an empty table an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM = 1, 90, 20
PLAIN, PSM_FORM, SPM_FORM = "plain", "psm", "spm"


def draws(doc_id: Column, seed: int = SEED, n: int = 4) -> Column:
    """The first n groups of eight hex digits of sha256("seed:id") as an array of integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)])


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, text, n, form, prefix, middle, suffix, output) for rows (doc_id, text).

    rate: per cent of the texts that are rearranged; spm: per cent of those that begin with the suffix.
    """
    p, s, m = map(F.lit, sentinels)
    text, pick = F.coalesce("text", F.lit("")), lambda i: F.col("draw")[i]
    rows = docs.select("doc_id", text.alias("text"), draws(F.col("doc_id"), seed).alias("draw"))
    rows = rows.withColumn("units", F.regexp_extract_all("text", F.lit(UNIT), F.lit(0))).withColumn("n", F.size("units").cast("long"))
    cut = lambda i: F.pmod(pick(i), F.col("n") + 1)
    held = F.lit(False)
    for mark in sentinels:
        held = held | F.contains("text", F.lit(mark))
    whole = (F.col("n") == 0) | held | (F.pmod(pick(2), F.lit(100)) >= rate)
    form = F.when(whole, PLAIN).when(F.pmod(pick(3), F.lit(100)) < spm, SPM_FORM).otherwise(PSM_FORM)
    rows = rows.withColumns({"form": form, "lo": F.least(cut(0), cut(1)).cast("int"), "hi": F.greatest(cut(0), cut(1)).cast("int")})
    part = lambda a, b: F.when(F.col("form") != PLAIN, F.array_join(F.slice("units", a + 1, b - a), ""))
    rows = rows.select("doc_id", "text", "n", "form", part(F.lit(0), F.col("lo")).alias("prefix"), part(F.col("lo"), F.col("hi")).alias("middle"), part(F.col("hi"), F.size("units")).alias("suffix"))
    output = F.when(F.col("form") == PSM_FORM, F.concat(p, "prefix", s, "suffix", m, "middle")).when(F.col("form") == SPM_FORM, F.concat(s, "suffix", p, "prefix", m, "middle")).otherwise(F.col("text"))
    return rows.withColumn("output", output)


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that was arranged; null where the sentinels of the form are not in place."""
    p, s, m = sentinels

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        a, b = F.locate(second, output), F.locate(m, output)
        cut = lambda x, y: F.substring(output, x, y - x)
        whole = F.startswith(output, F.lit(first)) & (a > 0) & (b > a)
        one, two = cut(F.lit(len(first) + 1), a), cut(a + len(second), b)
        return F.when(whole, one), F.when(whole, two), F.substring(output, b + len(m), F.length(output))

    prefix, suffix, middle = parts(p, s)
    last, first, centre = parts(s, p)
    return F.when(form == PLAIN, output).when(form == PSM_FORM, F.concat(prefix, middle, suffix)).when(form == SPM_FORM, F.concat(first, centre, last))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda c: F.sha2(c, 256)
    chars = lambda c: F.length(c).cast("long").alias(f"{c}_chars")
    return rows.select("doc_id", "n", "form", chars("prefix"), chars("middle"), sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


_H = "('0x' || substr(d, {}, 8))::BIGINT"
ORACLE = f"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u FROM documents),
h AS (SELECT *, len(u) AS n, {_H.format(1)} AS h1, {_H.format(9)} AS h2, {_H.format(17)} AS h3, {_H.format(25)} AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS b, array_to_string(u[hi + 1:], '') AS c FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b WHEN 'spm' THEN '<S>' || c || '<P>' || a || '<M>' || b ELSE text END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
