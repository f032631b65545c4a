"""Bursts among words and sentences, and the script that comes of it.

words (clip, ix, w, start, end), sentences (clip, ix, text, start, end), bursts (clip, b_ix, start, end, label).

Points meet intervals through the interval index of `series`, and what comes before or after in time, or in number, is found by its segmented scan:
a long clip is neither compared pair by pair nor held by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import is_finite, pause_text
from ..model import Config
from ..sources import stages
from .series import SPAN, Running, piece_of_rows, piece_of_time, scan, within

def midpoint() -> Column:
    return (F.col("start") + F.col("end")) / 2.0


def bursts_to_sentences(bursts: DataFrame, sentences: DataFrame, cfg: Config, span: float = SPAN) -> DataFrame:
    """Each burst (its b_ix is unique in its clip) once, with `s_ix`: the first sentence that holds its midpoint (slack included), else the one
    with the nearest edge, the earliest of equal ones; sentence 0 if no sentence has times or the midpoint is not finite."""
    s = sentences.filter("start is not null and end is not null").select("clip", F.col("ix").alias("s_ix"), F.col("start").alias("sa"), F.col("end").alias("sb"))
    b = bursts.withColumn("mid", midpoint())
    bounds = s.select("clip", "s_ix", (F.col("sa") - cfg.slack).alias("lo"), (F.col("sb") + cfg.slack).alias("hi"))
    inside = within(b.select("clip", "b_ix", "mid"), bounds, ["clip"], "mid", "lo", "hi").groupBy("clip", "b_ix").agg(F.min("s_ix").alias("inside"))
    # the last edge before and the first after; of edges at one time that of the earliest sentence is nearest
    edges = s.select("clip", "s_ix", F.explode(F.array("sa", "sb")).alias("mid"))
    both = b.select("clip", "b_ix", "mid").unionByName(edges, allowMissingColumns=True).filter(is_finite(F.col("mid")))
    edge, is_burst = F.when(F.col("s_ix").isNotNull(), F.struct("mid", "s_ix")), F.col("s_ix").isNull()
    by = lambda t: [t, is_burst, -F.col("s_ix")]
    both = scan(both, ["clip"], piece_of_time(F.col("mid"), span), {"before": Running("last", edge, by(F.col("mid"))), "after": Running("last", edge, by(-F.col("mid")), down=True)}).filter(is_burst)
    near = lambda e: F.when(e.isNotNull(), F.struct(F.abs(F.col("mid") - e["mid"]).alias("d"), e["s_ix"].alias("s_ix")))
    best = both.select("clip", "b_ix", F.least(near(F.col("before")), near(F.col("after")))["s_ix"].alias("near"))
    placed = b.drop("mid").join(best, ["clip", "b_ix"], "left").join(inside, ["clip", "b_ix"], "left")
    return placed.withColumn("s_ix", F.coalesce("inside", "near", F.lit(0))).drop("inside", "near")


def words_in_sentences(words: DataFrame, sentences: DataFrame) -> DataFrame:
    """Timed words with each sentence that holds their start."""
    s = sentences.select("clip", F.col("ix").alias("s_ix"), (F.col("start") - 1e-6).alias("lo"), (F.col("end") + 1e-6).alias("hi"))
    return within(words, s, ["clip"], "start", "lo", "hi").drop("lo", "hi")


def overlapping(bursts: DataFrame, sentences: DataFrame, cfg: Config) -> DataFrame:
    """Sentences with the sorted labels of every burst whose midpoint is inside, slack included: a burst may appear in several, or in none."""
    b = bursts.select("clip", "b_ix", "label", midpoint().alias("mid"))
    s = sentences.select("clip", "ix", (F.col("start") - cfg.slack).alias("lo"), (F.col("end") + cfg.slack).alias("hi"))
    hit = within(b, s, ["clip"], "mid", "lo", "hi").groupBy("clip", "ix").agg(F.transform(F.array_sort(F.collect_list(F.struct("b_ix", "label"))), lambda x: x["label"]).alias("bursts"))
    return sentences.join(hit, ["clip", "ix"], "left").withColumn("bursts", F.coalesce("bursts", F.array().cast("array<string>")))


def slots(words: DataFrame, bursts: DataFrame, keys: list[str], span: float = SPAN, short: bool = False) -> DataFrame:
    """Bursts with `slot`: the place of the first word that starts at or after the midpoint (the number of words if none does), never
    before the slot of a burst that started earlier; and `bo`, their order by start.  words need `wi`, their place from 0."""
    both = bursts.withColumn("mid", midpoint()).unionByName(words.select(*keys, F.col("start").alias("mid"), "wi"), allowMissingColumns=True)
    is_burst, known = F.col("wi").isNull(), F.col("mid").isNotNull() & ~F.isnan("mid")
    later = Running("min", F.col("wi"), [-F.col("mid"), is_burst], down=True)
    raw = scan(both.filter(known), keys, piece_of_time(F.col("mid"), span), {"raw": later}, short).filter(is_burst)
    lost = both.filter(~known & is_burst).withColumn("raw", F.lit(None).cast("int"))
    n = words.groupBy(*keys).agg(F.count("*").alias("n"))
    b = raw.unionByName(lost).drop("mid", "wi").join(n, keys, "left").withColumn("raw", F.coalesce("raw", "n", F.lit(0))).drop("n")
    b = b if short else stages.once(b, "raw")  # the scan reads it twice
    by = [F.col("start"), F.col("b_ix")]
    return scan(b, keys, piece_of_time(F.col("start"), span), {"slot": Running("max", F.col("raw"), by), "bo": Running("sum", F.lit(1), by)}, short).drop("raw")


def numbered(words: DataFrame, keys: list[str], short: bool = False, with_gap: bool = False) -> DataFrame:
    """Words with a start, with `wi`, their place among them; with_gap: and the `gap` before them, as gaps gives it, in the same scan."""
    timed = words.filter("start is not null")
    found = {"wi": Running("sum", F.lit(1), [F.col("ix")])}
    if with_gap:
        found["gap"] = Running("last", F.coalesce("end", "start"), [F.col("ix")], before=True)
    w = scan(timed, keys, piece_of_rows(F.col("ix")), found, short).withColumn("wi", F.col("wi") - 1)
    return w.withColumn("gap", F.col("start") - F.col("gap")) if with_gap else w


def gaps(words: DataFrame, keys: list[str], cfg: Config, short: bool = False) -> DataFrame:
    """Words with `gap`: time since the end of the word before, or since its start if it has no end, whether its end is null or
    absent (a column can't tell the two); null for the first."""
    before = Running("last", F.coalesce("end", "start"), [F.col("wi")], before=True)
    return scan(words, keys, piece_of_rows(F.col("wi")), {"gap": before}, short).withColumn("gap", F.col("start") - F.col("gap"))


def inline(words: DataFrame, bursts: DataFrame, cfg: Config, keys: list[str], short: bool = False) -> DataFrame:
    """(keys, text): the words with `(label)` before the next word and `[pause]` in gaps that no burst fills; without timed words the bursts alone.

    The numbered words are a stage table unless short, since slots reads them several times.  A burst that fills a gap stands right before the gap's word.
    """
    w = numbered(words, keys, short, with_gap=cfg.pause > 0)
    w = (w if cfg.pause > 0 else w.withColumn("gap", F.lit(None).cast("double"))).select(*keys, "wi", "w", "start", "gap")
    w = w if short else stages.once(w, "numbered")
    b = slots(w.drop("gap"), bursts, keys, short=short)
    tok = lambda df, slot, kind, order, text, gap: df.select(*keys, slot.cast("int").alias("slot"), F.lit(kind).alias("kind"), order.cast("int").alias("o"), text.alias("tok"), gap.cast("double").alias("gap"))
    rows = tok(b, F.col("slot"), 0, F.col("bo"), F.concat(F.lit("("), "label", F.lit(")")), F.lit(None)).unionByName(tok(w, F.col("wi"), 1, F.lit(0), F.col("w"), F.col("gap")))
    listed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("slot", "kind", "o", "tok", "gap"))).alias("l"))
    filled = lambda i: F.coalesce(F.get("l", i - 1)["kind"] == 0, F.lit(False))
    said = lambda x, i: F.when((x["gap"] >= cfg.pause) & ~filled(i), F.concat_ws(" ", pause_text(x["gap"]), x["tok"])).otherwise(x["tok"])
    return listed.select(*keys, F.trim(F.array_join(F.transform("l", said), " ")).alias("text"))


def sentence_gaps(sentences: DataFrame) -> DataFrame:
    """Sentences with `gap`: start minus the last known end before."""
    last = Running("last", F.col("end"), [F.col("ix")], before=True)
    return scan(sentences, ["clip"], piece_of_rows(F.col("ix")), {"gap": last}).withColumn("gap", F.col("start") - F.col("gap"))


def labels_text(labels: Column) -> Column:
    return F.array_join(F.transform(labels, lambda x: F.concat(F.lit("("), x, F.lit(")"))), " ")


def without_stops(text: Column) -> Column:
    """Without full stops at the end."""
    return F.rtrim(text, F.lit("."))


def script_lines(words: DataFrame, sentences: DataFrame, bursts: DataFrame, cfg: Config) -> DataFrame:
    """(clip, ix, text, bursts): one line for each sentence, its words with the bursts that belong to it; and for a clip with bursts but no
    sentence one line of its bursts."""
    keys = ["clip", "s_ix"]
    sentences = stages.once(sentences, "sentences")
    placed = stages.once(bursts_to_sentences(bursts, sentences, cfg), "placed")
    inner = stages.once(words_in_sentences(words, sentences), "inner")
    order = F.array_sort(F.collect_list(F.struct("start", "b_ix", "label")))
    own = placed.groupBy(*keys).agg(F.transform(order, lambda x: x["label"]).alias("labels"))
    both = inner.join(own.select(*keys), keys, "left_semi")
    text = inline(both, placed.join(inner.select(*keys).distinct(), keys, "left_semi"), cfg, keys, short=True).withColumnRenamed("text", "inline")
    lines = sentence_gaps(sentences).withColumn("s_ix", F.col("ix")).join(own, keys, "left").join(text, keys, "left")
    body = F.when(F.col("labels").isNull(), F.col("text")).otherwise(F.coalesce("inline", F.trim(F.concat(without_stops(F.col("text")), F.lit(" "), labels_text(F.col("labels"))))))
    lead = F.when(F.col("gap") >= cfg.pause, F.concat(pause_text(F.col("gap")), F.lit(" "))).otherwise("") if cfg.pause > 0 else F.lit("")
    none = F.array().cast("array<string>")
    out = lines.select("clip", "ix", F.concat(lead, body).alias("text"), F.coalesce("labels", none).alias("bursts"))
    left = own.join(sentences.select("clip").distinct(), "clip", "left_anti").select("clip", F.col("s_ix").alias("ix"), labels_text(F.col("labels")).alias("text"), F.col("labels").alias("bursts"))
    return out.unionByName(left)


def document(general: DataFrame, lines: DataFrame) -> DataFrame:
    """(clip, document) from general (clip, text) and lines (clip, ix, cue, text)."""
    line = F.concat(F.lit("("), F.coalesce("cue", F.lit("")), F.lit(") "), "text")
    body = lines.groupBy("clip").agg(F.transform(F.array_sort(F.collect_list(F.struct("ix", line.alias("line")))), lambda x: x["line"]).alias("l"))
    g = general.join(body, "clip", "left")
    return g.select("clip", F.concat_ws("\n", F.concat(F.lit("GENERAL: "), "text"), F.lit("SCRIPT:"), F.array_join("l", "\n")).alias("document"))
