"""The whole flow over the test tables: users are the clips, their events the frames and words, suppliers of the same number give the scores."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import scoring as S
from ..operators import flow, seeded
from ..sources import stages
from . import demo, twins as T
from .demo import EVENT_CFG, LEXICON, table
from .queries import _TAX, _TAX_SQL, _scores, query

#: A frame is 6.67 units long, so exact and rounded times differ; three frames pass the floor, but not that of the transient groups.
FLOW_CFG = replace(EVENT_CFG, frames_per_second=0.15, min_duration=19.0, min_transient=30.0)
_FPS = f"{FLOW_CFG.frames_per_second}::DOUBLE"
_CLIP_SEED = lambda clip: f"({T.draw('0', 'clip', clip)} % {seeded.CLIP_SEEDS})"
_WORDS = f"""words AS (SELECT clip, (row_number() OVER (PARTITION BY clip ORDER BY frame_ix) - 1)::INT AS ix, event_type || frame_ix AS w, frame_ix / {_FPS} AS start, round(frame_ix / {_FPS} + floor(p) * 0.1, 2) AS "end"
  FROM frames WHERE event_type IN ('view', 'click'))"""
_CLIPS = f"""clips AS (SELECT clip, ((max(frame_ix) - clip % 3 * 2) / {_FPS})::DOUBLE AS dur, CASE WHEN clip % 5 <> 0 THEN (clip % 9 - 4) / 4.0::DOUBLE END AS expert, CASE WHEN clip % 11 = 4 THEN 'unreadable' END AS error FROM all_frames GROUP BY clip)"""


def _classes(segments: str, name: str) -> str:
    """CTE of segments (clip, start, end, ...) with label, grp, prob and p_noburst; probabilities come from a vector that clip and start choose."""
    return f"""{name}_p AS (SELECT s.*, list_transform(e.embedding, lambda x: 1.0::DOUBLE / (1.0 + exp(-(x::DOUBLE * 4)))) AS p FROM {segments} s JOIN embeddings e ON e.vec_id = (s.clip * 31 + floor(s.start)::BIGINT) % (SELECT count(*) FROM embeddings)),
{name}_c AS (SELECT * EXCLUDE (p), p[64] AS nb, list_max(p[1:63]) AS best, list_position(p[1:63], list_max(p[1:63])) - 1 AS ci, "end" - start < 0.1 AS short FROM {name}_p),
{name} AS (SELECT c.* EXCLUDE (nb, best, ci, short), class AS label, grp, CASE WHEN short THEN 0.0 WHEN nb < 0.5 THEN best ELSE nb END AS prob, CASE WHEN short THEN 1.0 ELSE nb END AS p_noburst
  FROM {name}_c c LEFT JOIN tax ON class_ix = CASE WHEN NOT short AND nb < 0.5 THEN ci END)"""


def _described(rows: str, k: int, always: tuple, gated: bool) -> str:
    """The description of other entities than the suppliers: rows are their scores and seeds."""
    experts = "experts AS (SELECT clip AS entity_id, expert FROM clips)"
    return T.detail(k, 3, always, gated, "seed").replace("FROM scores s JOIN stats", f"FROM ({rows}) s JOIN stats").replace(T.EXPERTS, experts)


_FLOOR = f"CASE WHEN label IS NULL THEN 0.0 WHEN grp IN ({T.TRANSIENT_LIST}) THEN {FLOW_CFG.min_transient} ELSE {FLOW_CFG.min_duration} END"
_GENERAL = _described(f"SELECT *, {_CLIP_SEED('entity_id')} AS seed FROM scores", FLOW_CFG.k_dims, FLOW_CFG.always_on, True)
_STYLE = _described(f"SELECT s.* REPLACE (s.entity_id * 1000000 + t.ix AS entity_id), xor({_CLIP_SEED('t.clip')}, (t.ix + 1) * {seeded.SENTENCE_STEP}) AS seed FROM scores s JOIN sent t ON t.clip = s.entity_id", flow.SENTENCE_DIMS, (), False)
_SEED = f"xor({_CLIP_SEED('c.clip')}, (c.ix + 1) * {seeded.SENTENCE_STEP})"
_PHRASE = f"replace({T.pick(T.PHRASES, T.draw(_SEED, 'burst', 'n.label'))}, '{{b}}', n.label)"
SQL = f"""WITH {_TAX_SQL}, {T.FRAMES.replace('frames AS', 'all_frames AS')},
{_CLIPS},
frames AS (SELECT f.* FROM all_frames f JOIN clips c USING (clip) WHERE c.error IS NULL),
{_WORDS},
{T.SENTENCES},
cut AS (SELECT f.* FROM frames f JOIN clips c USING (clip) WHERE f.frame_ix < trunc(c.dur * {_FPS})::INT + 1),
{T.ISLANDS.replace('FROM frames', 'FROM cut').replace('min(frame_ix)::DOUBLE AS start, (max(frame_ix) + 1)::DOUBLE', f'min(frame_ix) AS b_ix, min(frame_ix) / {_FPS} AS start, (max(frame_ix) + 1) / {_FPS}')},
{_classes('spans', 'known')},
found AS (SELECT clip, b_ix, round(start, 2) AS start, round("end", 2) AS "end", label, round(prob, 3) AS prob, label IS NOT NULL AND "end" - start >= {_FLOOR} AS kept FROM known),
bursts AS (SELECT * FROM found WHERE kept),
{T.SCRIPT[T.SCRIPT.index(T.PLACED):]},
{T.slots('words', 'bursts', 'clip', 'whole')},
{T.inline('clip', 'whole').replace('gaps AS', 'wgaps AS').replace('FROM gaps', 'FROM wgaps').replace('tok AS (', 'wtok AS (').replace('FROM tok', 'FROM wtok').replace('inl AS', 'winl AS')},
gen AS (SELECT c.clip, coalesce(text, {T.q(T.NOTHING)}) AS text FROM clips c LEFT JOIN ({T.render(FLOW_CFG.template, _GENERAL)}) ON entity_id = c.clip WHERE error IS NULL),
style AS (SELECT entity_id // 1000000 AS clip, entity_id % 1000000 AS ix, string_agg(phrase, '; ' ORDER BY part_ix, pos) AS p FROM ({_STYLE} SELECT * FROM detail) WHERE part <> 'quality' GROUP BY entity_id),
cue AS (SELECT s.*, coalesce('Delivered ' || p || '.', 'An even, unremarkable delivery.') AS cue FROM sent s LEFT JOIN style USING (clip, ix)),
seg AS (SELECT s.clip, s.ix, CASE WHEN ok THEN greatest(0.0, s.start - {FLOW_CFG.pad}) ELSE 0.0 END::DOUBLE AS start, CASE WHEN ok THEN least(dur, s."end" + {FLOW_CFG.pad}) ELSE dur END AS "end" FROM (SELECT *, coalesce("end" > start, false) AS ok FROM sent) s JOIN clips USING (clip)),
{_classes('seg', 'named')},
told AS (SELECT c.clip, string_agg(c.ix || '=' || CASE WHEN n.label IS NULL THEN c.cue ELSE rtrim(c.cue, '.') || ', ' || {_PHRASE} || '.' END, ' | ' ORDER BY c.ix) AS told FROM cue c JOIN named n USING (clip, ix) GROUP BY c.clip),
doc AS (SELECT l.clip, string_agg('(' || coalesce(cue, '') || ') ' || l.text, chr(10) ORDER BY l.ix) AS body, string_agg(l.bursts, ';' ORDER BY l.ix) AS line_bursts FROM lines l LEFT JOIN cue c USING (clip, ix) GROUP BY l.clip),
spanned AS (SELECT clip, count(*) AS n, string_agg(start::DECIMAL(20,2) || '-' || "end"::DECIMAL(20,2) || ' ' || coalesce(label, '?') || CASE WHEN kept THEN '' ELSE '!' END, ' ' ORDER BY b_ix) AS said FROM found GROUP BY clip),
timed AS (SELECT clip, count(*) AS n FROM words GROUP BY clip)
SELECT c.clip, error, CASE WHEN error IS NULL THEN round(dur, 2) END AS dur, CASE WHEN error IS NULL THEN round(expert, 3) END AS expert, CASE WHEN error IS NULL THEN coalesce(abs(expert) < 0.5, false) END AS gated, gen.text AS global_caption,
  'GENERAL: ' || gen.text || chr(10) || 'SCRIPT:' || coalesce(chr(10) || body, '') AS document, CASE WHEN error IS NULL THEN coalesce(winl.text, '') END AS inline, CASE WHEN error IS NULL THEN coalesce(spanned.n, 0) END AS n_spans, CASE WHEN error IS NULL THEN coalesce(timed.n, 0) END AS n_words,
  coalesce(told, '') AS told, coalesce(line_bursts, '') AS line_bursts, coalesce(said, '') AS spans
FROM clips c LEFT JOIN gen USING (clip) LEFT JOIN doc USING (clip) LEFT JOIN winl USING (clip) LEFT JOIN spanned USING (clip) LEFT JOIN timed USING (clip) LEFT JOIN told USING (clip)"""


def _given(spark, sf):
    frames = stages.once(demo.event_frames(spark, sf), "frames")
    k, at = F.col("clip"), F.col("frame_ix") / FLOW_CFG.frames_per_second
    dur = (F.max("frame_ix") - F.pmod(k, F.lit(3)) * 2) / FLOW_CFG.frames_per_second
    clips = frames.groupBy("clip").agg(dur.alias("dur"))
    clips = clips.select("clip", "dur", F.when(F.pmod(k, F.lit(5)) != 0, (F.pmod(k, F.lit(9)) - 4) / 4.0).alias("expert"), F.when(F.pmod(k, F.lit(11)) == 4, "unreadable").alias("error"))
    spoken = frames.filter("word_ix is not null")
    words = spoken.select("clip", F.col("word_ix").alias("ix"), F.concat("event_type", F.col("frame_ix").cast("string")).alias("w"), at.alias("start"), F.round(at + F.floor("p") * 0.1, 2).alias("end"))
    sentences = stages.once(demo.sentences_of(words), "said")
    scores = _scores(spark, sf)
    inner = scores.join(sentences.select(F.col("clip").alias("entity_id"), "ix"), "entity_id").withColumn("entity_id", F.struct(F.col("entity_id").alias("clip"), "ix")).drop("ix")
    return flow.Clips(clips, frames, words, sentences, scores, inner), scores


@query("flow_captions", SQL)
def flow_captions(spark, sf):
    given, scores = _given(spark, sf)
    vectors = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: S.sigmoid(x.cast("double") * 4)).alias("scores"))
    n = vectors.count()
    classifier = lambda seg: seg.withColumn("vec_id", F.pmod(F.col("clip") * 31 + F.floor("start"), F.lit(n))).join(vectors, "vec_id").drop("vec_id")
    # rows made by the JVM: no Python worker starts for them
    taxonomy = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("class_ix"), F.lit(c).alias("class"), F.lit(g).cast("string").alias("grp")) for i, c, g in _TAX])))
    out = flow.captions(given, stages.once(demo.supplier_baseline(scores), "baseline"), classifier, taxonomy, LEXICON, FLOW_CFG)
    told = F.array_join(F.transform("sentences", lambda s: F.concat(s["ix"].cast("string"), F.lit("="), s["burst_caption"])), " | ")
    line = F.array_join(F.transform("lines", lambda x: F.array_join(x["bursts"], ",")), ";")
    two = lambda c: c.cast("decimal(20,2)").cast("string")
    said = F.array_join(F.transform("bursts", lambda b: F.concat(two(b["start"]), F.lit("-"), two(b["end"]), F.lit(" "), F.coalesce(b["label"], F.lit("?")), F.when(b["kept"], "").otherwise("!"))), " ")
    empty = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return out.select("clip", "error", "dur", "expert", "gated", "global_caption", "document", "inline", "n_spans", "n_words", empty(told, "told"), empty(line, "line_bursts"), empty(said, "spans"))
