"""Events in frame series: runs above a threshold, classes, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import is_finite
from ..model import TRANSIENT, Config
from ..sources import stages
from .series import runs


def islands(frames: DataFrame, cfg: Config, durations: DataFrame | None = None) -> DataFrame:
    """(clip, start, end, n_frames, peak) of maximal runs of frames (clip, frame_ix, p) with p at or above the threshold.

    Runs are found in pieces of the frames and put together at the pieces' edges, so a long clip is many tasks'.
    durations: (clip, dur); frames after int(dur * fps) + 1 are cut first.
    """
    f = frames
    if durations is not None:
        f = f.join(durations, "clip").filter(F.col("frame_ix") < (F.col("dur") * cfg.frames_per_second).cast("int") + 1)
    hot = f.filter(is_finite(F.col("p")) & (F.col("p") >= cfg.locator_threshold))
    found = runs(hot, ["clip"], "frame_ix", {"peak": ("max", "p")})
    fps = F.lit(float(cfg.frames_per_second))
    return found.filter(F.col("n") >= cfg.min_frames).select("clip", (F.col("i") / fps).alias("start"), ((F.col("j") + 1) / fps).alias("end"), F.col("n").alias("n_frames"), "peak")


def classify(spans: DataFrame, taxonomy: DataFrame, cfg: Config, length: Column | None = None) -> DataFrame:
    """label, prob and p_noburst from `scores`: an array of class probabilities in class order with no_burst last.

    A segment under 0.1 s is (null, 0, 1); if no_burst is likely the label is null and prob its probability; else the best of the
    other classes, the first of equal ones.  taxonomy: (class_ix, class, grp).
    """
    n = F.size("scores") - 1
    nb = F.element_at("scores", -1)
    best = F.array_max(F.slice("scores", 1, n))
    ix = (F.array_position(F.slice("scores", 1, n), best) - 1).cast("int")
    short = (length < 0.1) if length is not None else F.lit(False)
    said = ~short & (nb < cfg.no_burst_gate)
    s = spans.withColumns({"class_ix": F.when(said, ix), "prob": F.when(short, 0.0).when(said, best).otherwise(nb), "p_noburst": F.when(short, 1.0).otherwise(nb)})
    names = stages.small(stages.once(taxonomy.select("class_ix", F.col("class").alias("label"), "grp"), "taxonomy"))
    return s.join(names, "class_ix", "left").drop("class_ix", "scores")


def duration_gate(spans: DataFrame, cfg: Config) -> DataFrame:
    """dur_floor, dur_gated and kept from the exact start and end; then the rounded columns.  Needs label and grp."""
    dur = F.col("end") - F.col("start")
    floor = F.when(F.col("label").isNull(), 0.0).when(F.col("grp").isin(list(TRANSIENT)), cfg.min_transient).otherwise(cfg.min_duration)
    ok = F.col("label").isNotNull() & (dur >= floor)
    s = spans.withColumns({"dur": dur, "dur_floor": floor, "dur_gated": F.col("label").isNotNull() & ~ok, "kept": ok})
    return s.withColumns({c: F.round(c, d) for c, d in (("start", 2), ("end", 2), ("dur", 2), ("dur_floor", 2), ("peak", 3), ("prob", 3), ("p_noburst", 3)) if c in s.columns})
