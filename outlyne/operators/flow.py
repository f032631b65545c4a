"""Clips from frames and scores to finished captions in one call: segment, classify, gate, place, write.

clips (clip, dur, expert, error): every clip that should appear; dur in seconds, expert is the value that gates `cfg.gated_dim`, or null;
a clip with an error has no other result.  frames (clip, frame_ix, p), words (clip, ix, w, start, end), sentences (clip, ix, text, start, end),
scores (entity_id, grp, dim, dim_ix, value) of clips, sentence_scores the same with entity_id a struct (clip, ix).

A classifier is a function that adds `scores`, the class probabilities with no_burst last, to segments (clip, start, end, ...); it sees exact times.
Times are rounded before bursts are placed, so the texts follow from the bursts that are shown.  What has no row in clips is left out; a clip without
scores, frames, words or sentences has the text that the empty list gives.  Each clip is in clips once, each burst's row in one task and its texts in one row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import segment
from ..model import Config, Lexicon
from ..sources import stages
from . import placement, render, seeded, select
from .select import KEY
from .spans import classify, duration_gate, islands

Classifier = Callable[[DataFrame], DataFrame]
SENTENCE_DIMS = 3


@dataclass(frozen=True)
class Clips:
    """What is known of the clips; see the module."""

    clips: DataFrame
    frames: DataFrame
    words: DataFrame
    sentences: DataFrame
    scores: DataFrame
    sentence_scores: DataFrame


def bursts(frames: DataFrame, clips: DataFrame, classifier: Classifier, taxonomy: DataFrame, cfg: Config) -> DataFrame:
    """(clip, b_ix, start, end, n_frames, peak, label, grp, prob, p_noburst, dur, dur_floor, dur_gated, kept) of all spans; b_ix is the first frame."""
    found = islands(frames, cfg, clips.select("clip", "dur"))
    found = found.withColumn("b_ix", F.round(F.col("start") * float(cfg.frames_per_second)).cast("long"))
    return duration_gate(classify(classifier(found), taxonomy, cfg, F.col("end") - F.col("start")), cfg)


def general(scores: DataFrame, clips: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config) -> DataFrame:
    """(clip, text): the general line of each clip, synonyms drawn by the clip's seed, the gated dimension by its expert value."""
    d = select.detail(scores, baseline, lexicon, cfg, seeded.clip_seed(F.col(KEY)), clips.select(F.col("clip").alias(KEY), "expert"))
    return render.render(d, cfg.template, clips.select(F.col("clip").alias(KEY))).select(F.col(KEY).alias("clip"), "text")


def sentence_seed() -> Column:
    return seeded.sentence_seed(seeded.clip_seed(F.col("clip")), F.col("ix"))


def cues(sentence_scores: DataFrame, sentences: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config) -> DataFrame:
    """(clip, ix, cue): the style of each sentence, three dimensions at most and none always on."""
    seed = seeded.sentence_seed(seeded.clip_seed(F.col(f"{KEY}.clip")), F.col(f"{KEY}.ix"))
    d = select.detail(sentence_scores, baseline, lexicon, replace(cfg, k_dims=SENTENCE_DIMS, always_on=()), seed)
    return render.sentence_cue(d, cfg.template, sentences.select(F.struct("clip", "ix").alias(KEY))).select(f"{KEY}.clip", f"{KEY}.ix", "cue")


def sentence_bursts(sentences: DataFrame, clips: DataFrame, classifier: Classifier, taxonomy: DataFrame, cfg: Config) -> DataFrame:
    """(clip, ix, label, prob) of whole sentences, padded, or of the whole clip where a sentence has no times."""
    a, b = segment(F.col("start"), F.col("end"), F.col("dur"), cfg.pad)
    parts = sentences.select("clip", "ix", "start", "end").join(clips.select("clip", "dur"), "clip").select("clip", "ix", a.alias("start"), b.alias("end"))
    return classify(classifier(parts), taxonomy, cfg, F.col("end") - F.col("start")).select("clip", "ix", "label", F.round("prob", 3).alias("prob"))


def with_phrase(cue: Column, label: Column, seed: Column) -> Column:
    """The cue with a phrase that names the burst, if there is one."""
    return F.when(label.isNull(), cue).otherwise(F.concat(placement.without_stops(cue), F.lit(", "), seeded.burst_phrase(label, seed), F.lit(".")))


def _listed(df: DataFrame, name: str, order: str, *columns: str) -> DataFrame:
    """(clip, name): rows of a clip in order, as structs of some columns."""
    rows = F.array_sort(F.collect_list(F.struct(order, *(c for c in columns if c != order))))
    return df.groupBy("clip").agg(F.transform(rows, lambda r: F.struct(*(r[c].alias(c) for c in columns))).alias(name))


def captions(given: Clips, baseline: DataFrame, classifier: Classifier, taxonomy: DataFrame, lexicon: Lexicon, cfg: Config) -> DataFrame:
    """One row for each clip: (clip, error, dur, expert, gated, global_caption, document, inline, n_spans, n_words, sentences, lines, bursts).

    sentences: (ix, text, start, end, caption, burst, burst_prob, burst_caption); lines: (cue, text, bursts); bursts: all spans, kept or not.
    """
    clips = stages.once(given.clips.select("clip", "dur", "expert", "error"), "clips")
    good = clips.filter("error is null")
    only = lambda df: df.join(good.select("clip"), "clip", "left_semi")
    words, sentences = stages.once(only(given.words), "words"), stages.once(only(given.sentences), "sentences")
    found = stages.once(bursts(given.frames, good, classifier, taxonomy, cfg), "bursts")
    kept = found.filter("kept").select("clip", "b_ix", "start", "end", "label")
    cue = stages.once(cues(given.sentence_scores, sentences, baseline, lexicon, cfg), "cues")
    said = stages.once(general(given.scores, good, baseline, lexicon, cfg), "general")
    lines = stages.once(placement.script_lines(words, sentences, kept, cfg).join(cue, ["clip", "ix"], "left").withColumn("cue", F.coalesce("cue", F.lit(""))), "lines")
    named = sentence_bursts(sentences, good, classifier, taxonomy, cfg).withColumnsRenamed({"label": "burst", "prob": "burst_prob"})
    told = sentences.join(cue, ["clip", "ix"], "left").join(named, ["clip", "ix"], "left").withColumnRenamed("cue", "caption")
    told = told.withColumn("burst_caption", with_phrase(F.col("caption"), F.col("burst"), sentence_seed()))
    parts = [
        said.withColumnRenamed("text", "global_caption"),
        placement.document(said, lines),
        placement.inline(words, kept, cfg, ["clip"]).withColumnRenamed("text", "inline"),
        words.filter("start is not null").groupBy("clip").agg(F.count("*").alias("n_words")),
        _listed(told, "sentences", "ix", "ix", "text", "start", "end", "caption", "burst", "burst_prob", "burst_caption"),
        _listed(lines, "lines", "ix", "cue", "text", "bursts"),
        _listed(found, "bursts", "b_ix", "start", "end", "dur", "peak", "label", "prob", "p_noburst", "dur_floor", "dur_gated", "kept"),
    ]
    out = clips
    for p in parts:
        out = out.join(p, "clip", "left")
    ok = F.col("error").isNull()
    some = lambda c, other: F.when(ok, F.coalesce(c, other)).alias(c)
    none = {c: F.array().cast(out.schema[c].dataType) for c in ("sentences", "lines", "bursts")}
    gated = F.coalesce(F.abs("expert") < cfg.confidence_gate, F.lit(False))
    return out.select(
        "clip", "error", F.when(ok, F.round("dur", 2)).alias("dur"), F.when(ok, F.round("expert", 3)).alias("expert"), F.when(ok, gated).alias("gated"), "global_caption", "document",
        some("inline", F.lit("")), F.when(ok, F.greatest(F.size("bursts"), F.lit(0))).alias("n_spans"), some("n_words", F.lit(0)), *(some(c, x) for c, x in none.items()),
    )
