"""Score records: what is needed to write a text again later, and texts from them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import by_dim, draw, pick, scalar_cell
from ..model import TEMPLATES, Config, Lexicon
from ..sources import stages
from . import render, seeded, select
from .placement import document, labels_text, overlapping, without_stops
from .select import KEY


def score_record(clips: DataFrame, sentences: DataFrame, bursts: DataFrame, cfg: Config) -> DataFrame:
    """(clip, ei_gender, global_scores, sentences): one row for each clip, with its sentences' texts, times, scores and kept bursts.

    clips: (clip, ei_gender, global_scores); sentences also have `scores`; bursts only those that were kept.
    """
    s = overlapping(bursts, sentences, cfg)
    if "scores" not in s.columns:
        s = s.withColumn("scores", F.lit(None).cast("map<string,double>"))
    each = s.groupBy("clip").agg(F.collect_list(F.struct("ix", "text", "start", "end", "scores", "bursts")).alias("l"))
    ordered = F.array_sort("l", lambda a, b: a["ix"] - b["ix"])
    each = each.select("clip", F.transform(ordered, lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"), x["end"].alias("end"), x["scores"].alias("scores"), x["bursts"].alias("bursts"))).alias("sentences"))
    return clips.join(each, "clip", "left")


def rerender_lines(lines: DataFrame) -> DataFrame:
    """(clip, ix, cue, text) from stored sentences (clip, ix, text, bursts, cue): bursts at the end, no pauses."""
    tail = F.trim(F.concat(without_stops(F.col("text")), F.lit(" "), labels_text(F.col("bursts"))))
    return lines.select("clip", "ix", "cue", F.when(F.size("bursts") > 0, tail).otherwise(F.col("text")).alias("text"))


def sentence_seeds(lines: DataFrame) -> DataFrame:
    """Lines with the seed of their own, from `seed` and `ix`."""
    return lines.withColumn("sentence_seed", seeded.sentence_seed(F.col("seed"), F.col("ix")))


_PARTS = {"dims": "trait", "emo": "emotion", "genu": "quality", "blend": "quality"}
_CELLS = ("pos", "dim", "name", "value", "z", "direction", "intensity", "always_on", "phrase", "tag")


def scores_of(predictions: DataFrame, baseline: DataFrame) -> DataFrame:
    """(entity_id, grp, dim, dim_ix, value) of prediction documents (entity_id, preds), nested or flat; a cell without a number is null.

    Documents are stored once and dealt out by number, since they are small next to the work of parsing them, and so are the values, which are read again
    by what describes them.
    """
    n = int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = select.normalise_layout(stages.once(predictions.select(KEY, "preds").repartition(n), "predictions"), baseline)
    grp = by_dim(F.col("grp"), _PARTS)
    dim = F.when(F.col("grp") == "genu", "genuineness").when(F.col("grp") == "blend", "blend").otherwise(F.col("dim"))
    return stages.once(rows.select(KEY, grp.alias("grp"), dim.alias("dim"), "dim_ix", scalar_cell(F.col("cell")).alias("value")), "values")


def detail_json(detail: DataFrame) -> DataFrame:
    """(entity_id, json): an object with the lists dims, emotions and quality, each in order."""
    rows = detail.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("part_ix", *_CELLS[:2], "part", *_CELLS[2:]))).alias("r"))
    part = lambda name: F.transform(F.filter("r", lambda x: x["part"] == name), lambda x: F.struct(*(x[c].alias(c) for c in _CELLS))).alias(name)
    return rows.select(KEY, F.to_json(F.struct(*map(part, ("dims", "emotions", "quality")))).alias("json"))


def caption(predictions: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config, output: str = "text", seed: Column | None = None, experts: DataFrame | None = None, shuffle: bool = False) -> DataFrame:
    """From prediction documents (entity_id, preds) to what is said of each: output is text (entity_id, template, text), list (entity_id,
    phrases), or json (entity_id, json).  cfg.template names the form; `random` draws one by seed and entity.  seed: a literal or a column of entity_id."""
    d = select.detail(scores_of(predictions, baseline), baseline, lexicon, cfg, seed, experts, shuffle)
    if output == "json":
        return detail_json(d)
    if output == "list":
        return render.groups(d).select(KEY, F.col("ordered").alias("phrases"))
    if output != "text":
        raise ValueError(output)
    form: str | Column = cfg.template
    if form == "random":
        form = pick(TEMPLATES, draw(F.lit(0) if seed is None else seed, "template", F.col(KEY)))
    return render.render(d, form, predictions.select(KEY))


def _drawn(scores: DataFrame, who: DataFrame, template: str | None) -> tuple[DataFrame, DataFrame]:
    """Scores with the synonym seed and shuffling of their entity, and the entities with their form."""
    form, synonym, shuffled = seeded.augment_draws(F.col("seed"))
    who = who.select(KEY, (F.lit(template) if template else form).alias("form"), synonym.alias("synonym_seed"), shuffled.alias("shuffled"))
    return scores.join(who.drop("form"), KEY), who.select(KEY, "form")


def augment_global(scores: DataFrame, who: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config, template: str | None = None, gated: bool = True) -> DataFrame:
    """(entity_id, template, text): the general line anew from stored scores, its form, synonyms and order drawn by seed.

    who: (entity_id, seed, expert); gated: the stored expert value decides about the gated dimension.  An entity without scores gets the fixed sentence.
    """
    rows, forms = _drawn(scores, who, template)
    d = select.detail(rows, baseline, lexicon, cfg, F.col("synonym_seed"), who.select(KEY, "expert") if gated else None, F.col("shuffled"))
    return render.render(d, F.col("form"), forms)


def augment_sentences(scores: DataFrame, who: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config, template: str | None = None, k: int = 3) -> DataFrame:
    """(entity_id, cue): style cues of sentences from their stored scores, k dimensions each, none always on.  who: (entity_id, seed)."""
    rows, forms = _drawn(scores, who, template)
    d = select.detail(rows, baseline, lexicon, replace(cfg, k_dims=k, always_on=()), F.col("synonym_seed"), None, F.col("shuffled"))
    return render.sentence_cue(d, F.col("form"), forms)


def augment_script(general: tuple[DataFrame, DataFrame], sentence_scores: DataFrame, sentences: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config, template: str | None = None, gated: bool = True) -> DataFrame:
    """(clip, document): general line and script anew.

    general: scores (entity_id, grp, dim, dim_ix, value) and who (entity_id, seed, expert) of the clips; sentence_scores: the same
    of sentences, whose entity_id is a struct (clip, ix); sentences: (clip, ix, text, bursts).
    """
    scores, who = general
    text = augment_global(scores, who, baseline, lexicon, cfg, template, gated).select(F.col(KEY).alias("clip"), "text")
    seeds = sentences.join(who.select(F.col(KEY).alias("clip"), "seed"), "clip").select(F.struct("clip", "ix").alias(KEY), seeded.sentence_seed(F.col("seed"), F.col("ix")).alias("seed"))
    cues = augment_sentences(sentence_scores, seeds, baseline, lexicon, cfg, template).select(f"{KEY}.clip", f"{KEY}.ix", "cue")
    return document(text, rerender_lines(sentences.join(cues, ["clip", "ix"], "left")))
