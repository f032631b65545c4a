"""Scores of a stream against a fixed baseline, and runs of streamed frames.  The data flow itself is a batch; this is an addition."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from ..functions.scoring import is_finite, spread, tier, zscore
from ..model import Config
from ..sources import stages


def score_stream(stream: DataFrame, baseline: DataFrame) -> DataFrame:
    """z and intensity of streamed (dim, value, ...) rows: a stateless join with a static table."""
    b = stages.small(stages.once(baseline.select("dim", "median", "std", "mad", "spread"), "baseline"))
    z = zscore(F.col("value"), F.col("median"), spread(F.col("spread"), F.col("mad"), F.col("std")))
    return stream.join(b, "dim").withColumn("z", z).withColumn("intensity", tier(F.col("z"))).drop("median", "std", "mad", "spread")


def windowed_deviation(stream: DataFrame, time: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Largest |z| for each dimension and window; rows later than the watermark are left out."""
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return s.groupBy(F.window(time, width), "dim").agg(F.max(F.abs("z")).alias("max_abs_z"), F.count("*").alias("n"))


GROUPS = 512  # of clips that share a state


def live_islands(stream: DataFrame, cfg: Config, time: str, late: str = "10 seconds", groups: int = GROUPS) -> DataFrame:
    """(clip, start, end, n_frames, peak) of maximal runs of streamed frames (clip, frame_ix, p, time) with p at or above the threshold.

    A clip's state is its open runs, those that a frame which is not too late could still lengthen or join: memory grows with the hot frames inside the
    watermark's delay, not with the clip.  Frames may come in any order and more than once.  A run is given once, when the watermark has passed the time
    at which its next frame would be due, so the stream's last runs come when later frames of any clip arrive; frames later than the watermark are left
    out.  A null clip is a clip; frames without number, time, or finite p are left out.  Times must keep the order of the frames, cfg.frames_per_second apart.

    Clips are dealt by hash into groups, each of which is one call and one state for a batch, since a call costs milliseconds whatever it holds.  Another
    number of groups needs another checkpoint.
    """
    step = 1000.0 / cfg.frames_per_second
    hot = stream.filter(is_finite(F.col("p")) & (F.col("p") >= cfg.locator_threshold) & F.col("frame_ix").isNotNull() & F.col(time).isNotNull())
    named = F.struct("clip")  # as JSON, which pandas does not turn into a number where others are null
    cells = [F.pmod(F.xxhash64("clip"), F.lit(groups)).alias("part"), F.coalesce(F.to_json(named), F.lit("{}")).alias("id"), F.col("frame_ix").cast("long").alias("frame_ix"), F.col("p").cast("double").alias("p")]
    kind = dict(stream.dtypes)["clip"]
    hot = hot.select(*cells, F.col(time).alias("time")).withWatermark("time", late)

    def run(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs = list(zip(*state.get)) if state.exists else []
        for part in parts:
            ms = part["time"].astype("datetime64[ms]").astype("int64")
            frames = part["frame_ix"].tolist()
            runs += zip(part["id"].tolist(), frames, frames, part["p"].tolist(), ms.tolist())
        joined: list[tuple[str, int, int, float, int]] = []
        for clip, i, j, peak, ms in sorted(runs):
            if joined and clip == joined[-1][0] and i <= joined[-1][2] + 1:
                _, a, b, best, last = joined[-1]
                joined[-1] = clip, a, max(b, j), max(best, peak), max(last, ms)
            else:
                joined.append((clip, i, j, peak, ms))
        # a frame next to a run is due one step before or after it; below the watermark it would be too late
        mark = state.getCurrentWatermarkMs()
        done = [r for r in joined if r[4] + step < mark]
        open_ = [r for r in joined if r[4] + step >= mark]
        if open_:
            state.update(tuple(list(c) for c in zip(*open_)))
            state.setTimeoutTimestamp(max(int(min(r[4] for r in open_) + step) + 1, mark + 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame({"id": [r[0] for r in done], "i": [r[1] for r in done], "j": [r[2] for r in done], "peak": [r[3] for r in done]})

    held = "id array<string>, i array<bigint>, j array<bigint>, peak array<double>, last array<bigint>"
    found = hot.groupBy("part").applyInPandasWithState(run, "id string, i bigint, j bigint, peak double", held, "append", "EventTimeTimeout")
    fps, n = F.lit(float(cfg.frames_per_second)), F.col("j") - F.col("i") + 1
    clip = F.from_json("id", f"clip {kind}")["clip"].alias("clip")
    return found.filter(n >= cfg.min_frames).select(clip, (F.col("i") / fps).alias("start"), ((F.col("j") + 1) / fps).alias("end"), n.alias("n_frames"), "peak")
