"""Long series in pieces: points in intervals, running values and runs, so that no series is one task's.

Interval index: an interval is stored at its own length class, a power of two no shorter than itself, in the two cells of that class that it can
touch.  A point looks once into each class that occurs among the intervals.  So neither long nor many intervals multiply rows.

Segmented scan: a series is cut into pieces, which are solved apart; what a piece hands on (a sum, a maximum, the last value) is
added up over the pieces before it, a row for each piece, and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import stages

CLASSES = (-10, 60)  # exponents of the shortest and the longest cells; what is longer is in one cell
ROWS = 4096  # numbered rows of a piece
SPAN = 512.0  # time of a piece
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def _known(*times: str) -> Column:
    ok = F.lit(True)
    for t in times:
        ok = ok & F.col(t).isNotNull() & ~F.isnan(F.col(t).cast("double"))
    return ok


def length_class(lo: str, hi: str) -> Column:
    """The exponent of the cells that hold an interval."""
    low, high = CLASSES
    length = F.col(hi).cast("double") - F.col(lo)
    k = F.when(length <= 2.0**low, low).when(length > 2.0**high, high + 1).otherwise(F.ceil(F.log2(length)))
    return k.cast("int")


def cell(at: Column, k: Column) -> Column:
    """Number of the cell of class k that holds a time.  Past the range of integers it is the last or first one."""
    inner = F.floor(at.cast("double") / F.pow(F.lit(2.0), k))
    return F.when(k > CLASSES[1], F.lit(0)).otherwise(inner).cast("long")


def indexed(intervals: DataFrame, lo: str, hi: str) -> DataFrame:
    """intervals with _k and _cell, three times at most; those that hold no time are left out."""
    i = intervals.filter(_known(lo, hi) & (F.col(lo) <= F.col(hi))).withColumn("_k", length_class(lo, hi))
    return i.withColumn("_cell", F.explode(F.sequence(cell(F.col(lo), F.col("_k")), cell(F.col(hi), F.col("_k")))))


def looking(points: DataFrame, intervals: DataFrame, at: str, lo: str, hi: str) -> DataFrame:
    """points with _k and _cell, once for each class that occurs among the intervals, of which there are some seventy."""
    found = intervals.filter(_known(lo, hi) & (F.col(lo) <= F.col(hi))).agg(F.collect_set(length_class(lo, hi)).alias("k"))
    p = points.filter(_known(at)).withColumn("_k", F.explode(found.scalar()))
    return p.withColumn("_cell", cell(F.col(at), F.col("_k")))


def within(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, lo: str, hi: str) -> DataFrame:
    """Points joined with each interval that holds them: keys equal, lo <= at <= hi.

    A time that is null or not a number meets nothing; infinite ends are ends like others.
    """
    hit = looking(points, intervals, at, lo, hi).join(indexed(intervals, lo, hi), [*keys, "_k", "_cell"])
    return hit.filter((F.col(lo) <= F.col(at)) & (F.col(at) <= F.col(hi))).drop("_k", "_cell")


def piece_of_time(at: Column, span: float = SPAN) -> Column:
    """Number of the piece of time, in the order in which Spark sorts times: null first, not a number last."""
    return F.when(at.isNull(), F.lit(_FIRST)).when(F.isnan(at.cast("double")), F.lit(_LAST)).otherwise(F.floor(at / span)).cast("long")


def piece_of_rows(ix: Column, rows: int = ROWS) -> Column:
    return F.floor(ix / rows).cast("long")


@dataclass(frozen=True)
class Running:
    """A running value: how is sum, min, max or last (the last that is not null) of `value` over the rows up to this one in the order of `by`.

    before: without the row itself; down: pieces are gone through from the last to the first.
    """

    how: str
    value: Column
    by: Sequence[Column]
    before: bool = False
    down: bool = False

    def of(self, rows: Column) -> Column:
        return F.last(rows, ignorenulls=True) if self.how == "last" else {"sum": F.sum, "min": F.min, "max": F.max}[self.how](rows)

    def whole(self) -> Column:
        """Of all rows of a piece."""
        return F.max_by(self.value, F.when(self.value.isNotNull(), F.struct(*self.by))) if self.how == "last" else self.of(self.value)

    def joined(self, carry: Column, own: Column) -> Column:
        if self.how == "sum":
            return F.coalesce(carry + own, carry, own)
        return F.coalesce(own, carry) if self.how == "last" else {"min": F.least, "max": F.greatest}[self.how](carry, own)


def scan(df: DataFrame, keys: list[str], piece: Column, values: dict[str, Running], short: bool = False) -> DataFrame:
    """df with running values within each series (keys).  `by` must sort rows as `piece` does, in reverse if down.

    short: each series is known to be small, like the words of a sentence; it is not cut then.
    """
    frame = lambda r, own: Window.partitionBy(*own).orderBy(*r.by).rowsBetween(Window.unboundedPreceding, -1 if r.before else 0)
    if short:
        return df.withColumns({c: r.of(r.value).over(frame(r, keys)) for c, r in values.items()})
    df = df.withColumn("_piece", piece)
    own = [*keys, "_piece"]
    total = df.groupBy(*own).agg(*[r.whole().alias(f"_{c}") for c, r in values.items()])
    along = lambda r: Window.partitionBy(*keys).orderBy(F.desc("_piece") if r.down else F.asc("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    carries = total.select(*own, *[r.of(F.col(f"_{c}")).over(along(r)).alias(f"_{c}") for c, r in values.items()])
    local = df.withColumns({c: r.of(r.value).over(frame(r, own)) for c, r in values.items()})
    both = local.join(carries, own, "left")
    return both.withColumns({c: r.joined(F.col(f"_{c}"), F.col(c)) for c, r in values.items()}).drop("_piece", *[f"_{c}" for c in values])


def runs(marked: DataFrame, keys: list[str], ix: str, values: dict[str, tuple[str, str]], rows: int = ROWS) -> DataFrame:
    """(keys, i, j, n, values) of the maximal runs of consecutive numbers `ix` among the rows of each series; values: name -> (min, max or sum, column).

    Runs are found within pieces of numbers, once, as a stage table; those that touch a piece's edge are then put together.
    """
    put = lambda how, c: {"min": F.min, "max": F.max, "sum": F.sum}[how](c)
    at = marked.withColumn("_piece", piece_of_rows(F.col(ix), rows))
    at = at.withColumn("_run", F.col(ix) - F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(ix)))
    found = at.groupBy(*keys, "_piece", "_run").agg(F.min(ix).alias("i"), F.max(ix).alias("j"), F.count("*").alias("n"), *[put(h, c).alias(k) for k, (h, c) in values.items()])
    found = stages.once(found, "runs")
    edge = (F.pmod("i", F.lit(rows)) == 0) | (F.pmod(F.col("j") + 1, F.lit(rows)) == 0)
    inner = found.filter(~edge).drop("_piece", "_run")
    line = Window.partitionBy(*keys).orderBy("i")
    open_ = found.filter(edge).withColumn("_new", F.coalesce((F.col("i") != F.lag("j").over(line) + 1).cast("int"), F.lit(1)))
    open_ = open_.withColumn("_run", F.sum("_new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = open_.groupBy(*keys, "_run").agg(F.min("i").alias("i"), F.max("j").alias("j"), F.sum("n").alias("n"), *[put(h, k).alias(k) for k, (h, _) in values.items()])
    return inner.unionByName(whole.drop("_run"))


def convolve(frames: DataFrame, keys: list[str], ix: str, x: str, kernel: Sequence[Sequence[Sequence[float]]], bias: Sequence[float], rows: int = ROWS) -> DataFrame:
    """(keys, ix, y): a convolution along each series of vectors x, one for each number ix; y has an output for each kernel (width, channel).

    Frames are dealt out in pieces of numbers; a piece also gets copies of the frames within half a width of its edges, so a long series is
    many tasks'.  A frame that is missing, and what lies beyond the ends, counts as zeros.
    """
    half = len(kernel[0]) // 2
    at = F.col(ix)
    near = F.array_distinct(F.array(piece_of_rows(at - half, rows), piece_of_rows(at, rows), piece_of_rows(at + half, rows)))
    dealt = frames.select(*keys, ix, x).withColumn("_piece", F.explode(near))
    around = Window.partitionBy(*keys, "_piece").orderBy(at.cast("long")).rangeBetween(-half, len(kernel[0]) - 1 - half)
    seen = dealt.withColumn("_near", F.collect_list(F.struct(at.alias("i"), F.col(x).alias("v"))).over(around)).filter(F.col("_piece") == piece_of_rows(at, rows))

    def output(w: Sequence[Sequence[float]], b: float) -> Column:
        taps = F.array(*[F.array(*map(F.lit, map(float, tap))) for tap in w])
        one = lambda s: F.aggregate(F.zip_with(s["v"], F.get(taps, (s["i"] - at + half).cast("int")), lambda a, c: a.cast("double") * c), F.lit(0.0), lambda t, v: t + F.coalesce(v, F.lit(0.0)))
        return F.aggregate("_near", F.lit(float(b)), lambda t, s: t + one(s))

    return seen.select(*keys, ix, F.array(*map(output, kernel, bias)).alias("y"))
