"""Mixing sources to target weights by weighted fair queueing.

Targets: each source gets a share of the budget by weight; a share stops at REPEAT times its source's tokens and the excess
is shared anew by weight (water filling; sorted by cap per weight, the level is the largest of the levels that leave the
sources before a position capped).  Queueing: a document's virtual finish time is the cumulative tokens of its source,
in a shuffled order and counted to the middle of the document, divided by the source's target.  The second pass over a
source goes on where the first ended.  Documents are then sorted globally by virtual time and cut at the budget.

Scale: the text is read once and only counts of words leave that stage.  A source's cumulative sum is taken in 4096
hash ranges with the ranges' totals added, so a source with a third of all rows is spread over tasks.  The global
cut is found from totals of 4096 time slots; the slot where the budget ends is cut into slots again until it has at most 100,000
rows, which one task sorts.  Each row then compares itself with that cut.  Targets are broadcast only below a counted size.

Nulls: a null text has no tokens; null is a source of its own, last; a null id takes part like any other.  Repeated rows each
count; those of one id and size are taken alike, unless row tells them apart.  A source without tokens has target 0 and takes 0.  Equal
times go by id, size, row and turn.  An empty table gives an empty result.  Texts of any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace, maybe_broadcast, table

WEIGHTS = (5, 2, 1)
REPEAT = 2
SEED = "mix-1:"
RANGES = 4096
SLOTS = 4096
ONE_TASK = 100_000  # rows that are sorted in one task at the end


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2)) -> DataFrame:
    """(source, s, source_size, target); s numbers the sources by code point, null last.  share: budget over all tokens."""
    num, den = share
    scale = 1
    for w in weights:
        scale *= w
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("s", F.row_number().over(by_name))
    t = t.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("s") - 1, F.lit(len(weights))).cast("int") + 1).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * REPEAT)
    order = Window.orderBy((F.col("cap") * scale / F.col("w")).cast("long"), "s")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(Window.partitionBy()) * num
    t = t.withColumn("level", (budget - before * den).cast("double") / (left * den).cast("double"))
    level = F.max("level").over(Window.partitionBy())
    return t.withColumn("target", F.least(F.col("cap").cast("double"), F.col("w").cast("double") * level)).select("source", "s", "source_size", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), seed: str = SEED, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, turns) for every row of docs (doc_id, text, source).

    row: a column of unique integers, which tells rows of equal id and size apart; the result then has it too.
    """
    ws = Workspace(docs.sparkSession, "mix")
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    order = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    own = F.col(row).cast("long") if row else F.lit(0).cast("long")
    sizes = ws.put("sizes", docs.select("doc_id", own.alias("row"), "source", size.alias("size"), order.alias("k")), narrow=True)
    targets = ws.put("targets", source_targets(sizes, weights, share))
    known = maybe_broadcast(targets, targets.count(), 96)
    rows = sizes.join(known, sizes["source"].eqNullSafe(known["source"])).select("doc_id", "row", known["source"], "s", "size", "source_size", "target", "k")
    rows = ws.put("rows", rows.withColumn("r", F.conv(F.substring("k", 1, 3), 16, 10).cast("int")))
    ranges = rows.groupBy("s", "r").agg(F.sum("size").alias("n"))
    ranges = ranges.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    in_range = Window.partitionBy("s", "r").orderBy("k", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    queue = rows.withColumn("cum", F.sum("size").over(in_range)).join(ranges.select("s", "r", "base"), ["s", "r"])
    half = F.col("base") + F.col("cum") - F.col("size") / F.lit(2.0)
    at = [(half + F.col("source_size") * p) / F.nullif(F.col("target"), F.lit(0.0)) for p in range(REPEAT)]
    queue = ws.put("queue", queue.select("doc_id", "row", "source", "size", "source_size", "target", F.array(*at).alias("vt")))
    ws.keep("queue")
    cut = _cut(queue, share)
    turns = F.lit(0)
    if cut is not None:
        vt, *last = (F.lit(x) for x in cut)
        last = F.struct(*(x.cast("long") for x in last))
        for p in range(REPEAT):
            v = F.col("vt")[p]
            here = F.struct(*(x.cast("long") for x in (_id(), F.col("size"), F.col("row"), F.lit(p))))
            turns = turns + F.when((v < vt) | ((v == vt) & (here <= last)), 1).otherwise(0)
    more = [F.col("row").alias(row)] if row else []
    return queue.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * turns).alias("taken"), turns.alias("turns"), *more)


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(-(1 << 63)))


def _cut(queue: DataFrame, share: tuple[int, int]) -> tuple | None:
    """The last (virtual time, id, size, row, turn) inside the budget; None if nothing is.

    Documents without tokens take nothing and are passed over, so equal times are those of different sources.
    """
    num, den = share
    total = queue.select(F.sum("size")).first()[0]
    if not total:
        return None
    rows = queue.filter("size > 0").select(_id().alias("id"), "size", "row", F.posexplode("vt").alias("turn", "v")).filter("v is not null")
    lo, hi = rows.select(F.min("v"), F.max("v")).first()
    base = 0
    while True:
        # totals of SLOTS slots of time, and the slot in which the budget ends
        width = (hi - lo) / SLOTS
        at = F.least(F.lit(SLOTS - 1), F.floor((F.col("v") - lo) / width)).cast("int") if width else F.lit(0)
        slots = rows.groupBy(at.alias("slot")).agg(F.sum("size").alias("n"), F.count("*").alias("k"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("slot").collect()
        for last in slots:
            if (base + last["n"]) * den > total * num:
                break
            base += last["n"]
        else:  # all is inside
            return (float("inf"), 0, 0, 0, 0)
        rows = rows.filter(at == last["slot"])
        if last["k"] <= ONE_TASK or last["lo"] == last["hi"]:
            break
        lo, hi = last["lo"], last["hi"]
    run = F.sum("size").over(Window.orderBy("v", "id", "size", "row", "turn").rowsBetween(Window.unboundedPreceding, 0)) + base
    found = rows.withColumn("run", run).filter(F.col("run") * den <= total * num).select(F.max(F.struct("v", "id", "size", "row", "turn"))).first()[0]
    # none: the cut is where the slot begins
    return tuple(found) if found else (last["lo"], -(1 << 63), -1, -1, -1)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source", "turns")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix-1:' || doc_id) AS k FROM documents),
n AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS s FROM n),
c AS (SELECT *, CASE (s - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, source_size * 2 AS cap FROM w),
l AS (SELECT *, (sum(source_size) OVER () * 3 - coalesce(sum(cap) OVER (ORDER BY cap * 10 // w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2)::DOUBLE
        / (sum(w) OVER (ORDER BY cap * 10 // w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * 2)::DOUBLE AS level FROM c),
t AS (SELECT source, s, source_size, least(cap::DOUBLE, w::DOUBLE * max(level) OVER ()) AS target FROM l),
q AS (SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY s ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0 AS half
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT doc_id, size, turn, (half + source_size * turn)::DOUBLE / nullif(target, 0) AS v FROM q, (SELECT unnest([0, 1]) AS turn)),
r AS (SELECT doc_id, size, sum(size) OVER (ORDER BY v, doc_id, size, turn ROWS UNBOUNDED PRECEDING) AS run, (SELECT sum(size) FROM d) AS total FROM p WHERE v IS NOT NULL),
g AS (SELECT doc_id, sum(CASE WHEN run * 2 <= total * 3 THEN size ELSE 0 END)::BIGINT AS taken FROM r GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(g.taken, 0)::BIGINT AS taken FROM q LEFT JOIN g USING (doc_id)
"""
