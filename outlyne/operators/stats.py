"""Robust statistics of a dimension's values.  Scores are long: one row for each (entity, dim, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import is_finite, stats_spread
from ..sources import stages

STATS = ("mean", "median", "std", "mad", "spread", "p10", "p90", "n")


def melt(df: DataFrame, keys: Sequence[str], dims: dict[str, Column]) -> DataFrame:
    """Long scores (keys, dim, value) from one expression for each dimension."""
    rows = F.array(*[F.struct(F.lit(d).alias("dim"), c.cast("double").alias("value")) for d, c in dims.items()])
    return df.select(*keys, F.explode(rows).alias("s")).select(*keys, "s.dim", "s.value")


def finite(scores: DataFrame) -> DataFrame:
    return scores.filter(is_finite(F.col("value")))


CUTS = 64
IN_TASK = 1_000_000  # distinct values of a group that one task may hold


def value_counts(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, value, c), as a stage table."""
    return stages.once(values.groupBy(*by, "value").agg(F.count("*").alias("c")), "counts")


def exact_quantiles(values: DataFrame, by: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """(by, q): exact quantiles at ps, interpolated between neighbours, of the finite `value`s of each group."""
    return quantiles_of_counts(value_counts(values, by), by, ps)


def quantiles_of_counts(counts: DataFrame, by: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """The same from a stored table of distinct values and their counts (by, value, c).

    Spark's own exact percentile holds a group's distinct values in one buffer; here no task holds a group.  Distinct values are
    cut into CUTS ranges at approximate quantiles (which only balance the work), and the ranges' totals say which ranges hold the wanted
    ranks; only those are ranked.
    """
    by = list(by)
    cuts = stages.once(counts.groupBy(*by).agg(F.percentile_approx("value", [i / CUTS for i in range(1, CUTS)], 2000).alias("cuts")), "cuts")
    counts = counts.join(stages.small(cuts, 10_000), by).withColumn("b", F.size(F.filter("cuts", lambda x: x < F.col("value")))).drop("cuts")
    total, before = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.groupBy(*by, "b").agg(F.sum("c").alias("m")).withColumns({"n": F.sum("m").over(total), "upto": F.sum("m").over(before)})
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(ps)])).alias("w")
    want = sums.select(*by, "b", "n", "m", "upto", at).withColumn("pos", (F.col("n") - 1) * F.col("w.p"))
    want = want.select(*by, "b", F.col("w.i").alias("i"), (F.col("upto") - F.col("m")).alias("base"), "m", "pos", F.explode(F.array(F.floor("pos"), F.floor("pos") + 1)).alias("r"))
    want = stages.once(want.filter((F.col("r") >= F.col("base")) & (F.col("r") < F.col("base") + F.col("m"))), "ranks")
    ranges = stages.once(want.select(*by, "b", "base").distinct(), "ranges")
    in_range = Window.partitionBy(*by, "b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(stages.small(ranges), [*by, "b"]).withColumn("end", F.col("base") + F.sum("c").over(in_range))
    hit = ranked.select(*by, "b", "value", "c", "end").join(stages.small(want.drop("base", "m")), [*by, "b"]).filter((F.col("r") < F.col("end")) & (F.col("r") >= F.col("end") - F.col("c")))
    weight = F.when(F.col("r") == F.floor("pos"), F.floor("pos") + 1 - F.col("pos")).otherwise(F.col("pos") - F.floor("pos"))
    each = hit.groupBy(*by, "i").agg(F.sum(F.when(weight > 0, F.col("value") * weight)).alias("v"))
    return each.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("q")).withColumn("q", F.transform("q", lambda x: x["v"]))


def _quantiles(counts: DataFrame, by: Sequence[str], ps: Sequence[float], distributed: bool) -> DataFrame:
    if distributed:
        return quantiles_of_counts(counts, by, ps)
    return counts.groupBy(*by).agg(F.percentile("value", F.array(*map(F.lit, ps)), F.col("c")).alias("q"))


def baseline_stats(scores: DataFrame, *keys: str, distributed: bool | None = None) -> DataFrame:
    """Statistics for each dim (and keys) over finite values, rounded to four places; the spread is taken before rounding.

    The median comes first, then the median of the distances from it.  Quantiles are exact and interpolate; both are taken from a stored
    table of distinct values and counts.  distributed: whether a group's distinct values are spread over tasks; if not given, they are when their counted
    number is above IN_TASK in any group.
    """
    by = ["dim", *keys]
    v = finite(scores).select(*by, "value")
    counts = value_counts(v, by)
    if distributed is None:
        distributed = (counts.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) > IN_TASK
    first = v.groupBy(*by).agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("sd"), F.count("*").alias("n"))
    first = stages.once(first.join(_quantiles(counts, by, (0.5, 0.1, 0.9), distributed).withColumnRenamed("q", "p"), by), "first")
    away = counts.join(stages.small(first.select(*by, F.col("p")[0].alias("md"))), by).select(*by, F.abs(F.col("value") - F.col("md")).alias("value"), "c")
    if distributed:
        away = stages.once(away.groupBy(*by, "value").agg(F.sum("c").alias("c")), "away")
    first = first.join(_quantiles(away, by, (0.5,), distributed).select(*by, F.col("q")[0].alias("mad")), by)
    r = lambda c: F.round(c, 4)
    return first.select(
        *by, r(F.col("m")).alias("mean"), r(F.col("p")[0]).alias("median"), r(F.col("sd")).alias("std"), r(F.col("mad")).alias("mad"),
        r(stats_spread(F.col("mad"), F.col("sd"))).alias("spread"), r(F.col("p")[1]).alias("p10"), r(F.col("p")[2]).alias("p90"), "n",
    )


def two_source_stats(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Statistics over both sources; dims of the secondary one alone are dropped.  Source counts come before the finite filter."""
    known = primary.select("dim").distinct()
    both = primary.select("dim", "value", F.lit(1).alias("src")).unionByName(secondary.join(stages.small(stages.once(known, "dims")), "dim", "left_semi").select("dim", "value", F.lit(2).alias("src")))
    counts = both.filter("value is not null").groupBy("dim").agg(F.count_if(F.col("src") == 1).alias("n_primary"), F.count_if(F.col("src") == 2).alias("n_secondary"))
    return baseline_stats(both).join(counts, "dim")


def document(stats: DataFrame, names: dict[str, str], group: str, ranges: dict[str, int] | None = None) -> DataFrame:
    """The rows of a baseline document: name, group and value range added, dims in code-point order."""
    name, top = F.col("dim"), F.lit(None).cast("int")
    for d, n in names.items():
        name = F.when(F.col("dim") == d, n).otherwise(name)
    for d, k in (ranges or {}).items():
        top = F.when(F.col("dim") == d, k).otherwise(top)
    span = F.when(top.isNotNull(), F.array(F.lit(0), top))
    return stats.withColumns({"name": name, "grp": F.lit(group), "range": span}).orderBy("dim")


def source_counts(index: DataFrame, *by: str) -> DataFrame:
    return index.groupBy(*by).agg(F.count("*").alias("n"))


def numbered_distinct(df: DataFrame, column: str) -> DataFrame:
    """(pos, column): distinct values in order, numbered from 0, without gathering them: ranges are numbered apart, behind the counts of earlier ones.

    Nulls are left out.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().repartitionByRange(ranges, column)
    rows = stages.once(rows.withColumn("_range", F.spark_partition_id()), "distinct")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    base = rows.groupBy("_range").agg(F.count("*").alias("c")).select("_range", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return rows.join(F.broadcast(base), "_range").select((F.col("base") + place).alias("pos"), column)


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    """Number and sorted list of distinct values, in one row; numbered_distinct gives a row for each."""
    return df.agg(F.count_distinct(column).alias("n"), F.array_sort(F.collect_set(column)).alias("names"))
