"""Interval index, segmented scan and runs against plain definitions."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from outlyne.model import Config
from outlyne.operators import placement, series, spans

INF, NAN = float("inf"), float("nan")


def plain_within(points, intervals):
    return sorted((k, p, i) for k, p, at in points for j, i, lo, hi in intervals if k == j and None not in (at, lo, hi) and lo <= at <= hi)


def test_within_any_interval(spark):
    """Lengths from nothing to infinity, ends on cell borders, times that are null, infinite or not a number."""
    rnd, times = random.Random(1), [None, NAN, INF, -INF, 0.0, -0.0, 1.0, 1e9, 1e300, -1e300]
    value = lambda: rnd.choice([rnd.uniform(-50, 50), float(rnd.randrange(-64, 64)), rnd.choice(times), rnd.uniform(-1e9, 1e9), rnd.randrange(-9, 9) / 1024])
    points = [(rnd.randrange(3), i, value()) for i in range(600)]
    intervals = []
    for i in range(500):
        lo = value()
        hi = rnd.choice([value(), lo, None if lo is None else lo + rnd.choice([0.001, 0.5, 1.0, 4.0, 1e9, INF])])
        intervals.append((rnd.randrange(3), i, lo, hi))
    p = spark.createDataFrame(points, "k int, p int, at double")
    i = spark.createDataFrame(intervals, "k int, i int, lo double, hi double")
    got = sorted((r["k"], r["p"], r["i"]) for r in series.within(p, i, ["k"], "at", "lo", "hi").collect())
    assert got == plain_within(points, intervals) and got
    assert series.within(p, i.limit(0), ["k"], "at", "lo", "hi").count() == series.within(p.limit(0), i, ["k"], "at", "lo", "hi").count() == 0


def test_within_rows_are_not_multiplied(spark):
    i = spark.createDataFrame([(1, n, float(n), float(n) + length) for n, length in enumerate([0.0, 1e-9, 0.3, 1.0, 7.0, 3600.0, 1e9, 1e15, INF] * 20)], "k int, i int, lo double, hi double")
    assert series.indexed(i, "lo", "hi").groupBy("i").count().filter("count > 3").isEmpty()
    p = spark.range(100).selectExpr("1 AS k", "id * 1D AS at")
    classes = series.looking(p, i, "at", "lo", "hi").groupBy("at").count().agg(F.max("count")).first()[0]
    assert classes <= 9


def test_bursts_beside_odd_sentences(spark):
    sn, b = "clip long, ix int, text string, start double, end double", "clip long, b_ix long, start double, end double, label string"
    s = spark.createDataFrame([(1, 0, "a.", 0.0, 1.0), (1, 1, "b.", 2.0, INF), (2, 0, "c.", 5.0, NAN), (2, 1, "d.", 7.0, 8.0), (3, 0, "e.", 0.0, 1e9)], sn)
    bursts = spark.createDataFrame([(1, 1, 1e12, 1e12, "far"), (1, 2, 1.4, 1.4, "near"), (2, 3, 6.5, 6.5, "nan"), (3, 4, 5e8, 5e8, "in"), (3, 5, None, 1.0, "none"), (3, 6, NAN, 1.0, "odd")], b)
    assert {r["label"]: r["s_ix"] for r in placement.bursts_to_sentences(bursts, s, Config()).collect()} == {"far": 1, "near": 0, "nan": 1, "in": 0, "none": 0, "odd": 0}
    got = {(r["clip"], r["ix"]): r["bursts"] for r in placement.overlapping(bursts, s, Config()).collect()}
    assert got == {(1, 0): [], (1, 1): ["far"], (2, 0): [], (2, 1): [], (3, 0): ["in"]}


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = [(k, i, rnd.choice([None, rnd.uniform(-5, 5)]), rnd.choice([None, rnd.randrange(100)])) for k in range(4) for i in range(0 if k == 3 else 200)]
    return spark.createDataFrame([*data, (9, 0, 1.0, 1)], "k int, ix int, t double, v int")


def test_scan_is_the_window(spark, rows):
    ix, v = F.col("ix"), F.col("v")
    values = {
        "total": series.Running("sum", v, [ix]), "low": series.Running("min", v, [ix], before=True), "high": series.Running("max", v, [-ix], down=True),
        "last": series.Running("last", v, [ix], before=True), "next": series.Running("last", v, [-ix], before=True, down=True),
    }
    up, before = Window.partitionBy("k").orderBy("ix").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("k").orderBy("ix").rowsBetween(Window.unboundedPreceding, -1)
    down, after = Window.partitionBy("k").orderBy(F.desc("ix")).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("k").orderBy(F.desc("ix")).rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumns({"total": F.sum("v").over(up), "low": F.min("v").over(before), "high": F.max("v").over(down), "last": F.last("v", True).over(before), "next": F.last("v", True).over(after)})
    listed = lambda df: sorted((tuple(r) for r in df.select("k", "ix", *values).collect()), key=repr)
    for step in (1, 7, 4096):
        assert listed(series.scan(rows, ["k"], series.piece_of_rows(ix, step), values)) == listed(want)
    assert listed(series.scan(rows, ["k"], F.lit(0), values, short=True)) == listed(want)


def test_scan_by_time(spark, rows):
    """Times with ties, nulls, infinities and no numbers."""
    odd = rows.withColumn("t", F.when(F.col("ix") % 50 == 0, float("nan")).when(F.col("ix") % 49 == 0, float("inf")).when(F.col("ix") % 47 == 0, float("-inf")).otherwise(F.round("t", 1)))
    by = [F.col("t"), F.col("ix")]
    w = Window.partitionBy("k").orderBy("t", "ix").rowsBetween(Window.unboundedPreceding, 0)
    want = odd.withColumns({"n": F.sum(F.lit(1)).over(w), "last": F.last("v", True).over(w)})
    got = series.scan(odd, ["k"], series.piece_of_time(F.col("t"), 0.7), {"n": series.Running("sum", F.lit(1), by), "last": series.Running("last", F.col("v"), by)})
    listed = lambda df: sorted((tuple(r) for r in df.select("k", "ix", "n", "last").collect()), key=repr)
    assert listed(got) == listed(want)


def test_runs_over_edges(spark):
    rnd = random.Random(8)
    data = [(k, i, rnd.random()) for k in range(3) for i in range(-40, 300) if rnd.random() < 0.9 or (k == 1 and 30 < i < 200)]
    df = spark.createDataFrame(data, "k int, ix int, p double")
    want, own = [], {}
    for k, i, p in data:
        if (k, i - 1) in own:
            run = own[k, i - 1]
            run[1], run[2], run[3] = i, run[2] + 1, max(run[3], p)
        else:
            run = [i, i, 1, p]
            want.append((k, run))
        own[k, i] = run
    want = sorted((k, *r) for k, r in want)
    for step in (1, 2, 16, 4096):
        got = series.runs(df, ["k"], "ix", {"p": ("max", "p")}, step)
        assert sorted(tuple(r) for r in got.select("k", "i", "j", "n", "p").collect()) == want


def test_one_clip_is_many_tasks(spark):
    """Five million frames of one clip: no task of the runs has more than a few pieces, and the runs are those of numpy."""
    n, cfg = 5_000_000, Config()
    frames = spark.range(n).select(F.lit(1).alias("clip"), F.col("id").alias("frame_ix"), (F.pmod(F.xxhash64(F.floor(F.col("id") / 5)), F.lit(10)) / 10.0).alias("p"))
    hot = frames.filter("p >= 0.75").withColumn("_piece", series.piece_of_rows(F.col("frame_ix")))
    task = hot.repartition(64, "clip", "_piece").groupBy(F.spark_partition_id().alias("t")).count()
    assert task.count() == 64 and task.agg(F.max("count")).first()[0] < 4 * task.agg(F.avg("count")).first()[0]
    got = spans.islands(frames, cfg).selectExpr("count(*)", "sum(n_frames)", "max(n_frames)").first()
    p = np.array([r[0] for r in frames.filter("frame_ix % 5 = 0").orderBy("frame_ix").select("p").collect()]).repeat(5) >= 0.75
    edge = np.flatnonzero(np.diff(np.concatenate(([0], p.astype(int), [0]))))
    lengths = edge[1::2] - edge[::2]
    assert tuple(got) == (len(lengths), int(lengths.sum()), int(lengths.max()))
    plan = spans.islands(frames, cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in plan
    one = spark.range(300_000).select(F.lit(1).alias("clip"), F.col("id").cast("int").alias("ix"), (F.col("id") * 0.5).alias("start"), (F.col("id") * 0.5 + 0.1).alias("end"))
    gap = placement.gaps(placement.numbered(one, ["clip"]), ["clip"], cfg).agg(F.count("gap"), F.round(F.min("gap"), 3), F.round(F.max("gap"), 3)).first()
    assert tuple(gap) == (299_999, 0.4, 0.4)
