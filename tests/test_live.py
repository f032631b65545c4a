"""Runs of streamed frames: order, lateness, repeats, restarts."""

import datetime as dt
import os

from outlyne.model import Config
from outlyne.streaming.live import live_islands

CFG = Config(frames_per_second=1, min_frames=2, locator_threshold=0.5)
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "clip string, frame_ix int, p double, time timestamp"


def _file(spark, folder, n, rows):
    """rows (clip, frame_ix, p) as the n-th file of a folder."""
    full = [(c, i, p, None if i is None else T0 + dt.timedelta(seconds=i)) for c, i, p in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    for f in os.listdir(folder):
        at = f"{folder}/{f}"
        if f.endswith(".parquet") and not f.startswith("."):
            if os.path.getmtime(at) > 1_600_000_000:
                os.utime(at, (1_500_000_000 + n, 1_500_000_000 + n))


def _drain(spark, folder, root, late):
    live = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    found = live_islands(live, CFG, "time", late)
    found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(found.schema).parquet(f"{root}/out").collect()
    return sorted((r["clip"] or "", r["start"], r["end"], r["n_frames"], r["peak"]) for r in rows)


def test_runs_across_files(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    # the middle of a run comes last, a frame comes twice, a clip has no name, values are missing
    _file(spark, folder, 0, [("a", 0, 0.9), ("a", 1, 0.6), ("a", 4, 0.7), (None, 3, 0.5), ("b", 2, 0.9), ("b", 3, 0.1), ("n", None, 0.9), ("n", 1, None), ("n", 2, float("nan"))])
    _file(spark, folder, 1, [("a", 3, 0.8), ("a", 1, 0.6), (None, 4, 0.7), ("b", 4, 0.9)])
    _file(spark, folder, 2, [("a", 2, 0.95), ("a", 9, 0.9), ("a", 10, 0.9)])
    _file(spark, folder, 3, [("z", 100, 0.9), ("z", 101, 0.9)])
    got = _drain(spark, folder, root, "20 seconds")
    assert got == [("", 3.0, 5.0, 2, 0.7), ("a", 0.0, 5.0, 5, 0.95), ("a", 9.0, 11.0, 2, 0.9)]  # z may still grow
    # after a restart the state is still there: z grows, and what is later than the watermark is left out
    _file(spark, folder, 4, [("z", 102, 1.0), ("a", 5, 0.9), ("a", 6, 0.9)])
    _file(spark, folder, 5, [("y", 300, 0.9)])
    assert _drain(spark, folder, root, "20 seconds") == [*got, ("z", 100.0, 103.0, 3, 1.0)]


def test_no_frames(spark, tmp_path):
    folder = str(tmp_path / "in")
    _file(spark, folder, 0, [("a", 0, 0.1)])
    assert _drain(spark, folder, str(tmp_path), "5 seconds") == []


def test_many_clips_share_a_call(spark, tmp_path):
    """Clips of one group keep their own runs; large numbers beside a null clip stay exact, and states are as many as groups."""
    from pyspark.sql import functions as F

    folder, big = str(tmp_path / "in"), 1 << 60
    ids = [None, *range(big, big + 40)]
    rows = [(c, i, 0.9, T0 + dt.timedelta(seconds=i)) for c in ids for i in (0, 1, 2, 7, 8)] + [(-1, 900, 0.9, T0 + dt.timedelta(seconds=900))]
    kind = "clip bigint, frame_ix int, p double, time timestamp"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(folder)
    live = spark.readStream.schema(kind).parquet(folder)
    found = live_islands(live, CFG, "time", "20 seconds", groups=4)
    q = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.schema(found.schema).parquet(f"{tmp_path}/out").select(F.col("clip"), "start", "n_frames").collect()
    assert sorted((r[0] or 0, r[1], r[2]) for r in got) == sorted((c or 0, a, n) for c in ids for a, n in ((0.0, 3), (7.0, 2)))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 4
