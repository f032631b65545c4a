"""Text from a description, in one of eleven forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import first_upper
from ..model import NOTHING, TEMPLATES
from .select import KEY


def groups(detail: DataFrame) -> DataFrame:
    """One row for each entity with the phrase lists ordered, ident, timbre, emo, q, tags, and idmap: dim -> phrase of always-on dims."""
    row = F.struct("part_ix", "pos", "part", "dim", "always_on", "phrase", "tag")
    g = detail.groupBy(KEY).agg(F.array_sort(F.collect_list(row)).alias("r"))
    some = lambda keep: F.transform(F.filter("r", lambda x: keep(x) & x["phrase"].isNotNull()), lambda x: x["phrase"])
    always = lambda x: (x["part"] == "dims") & x["always_on"]
    return g.select(
        KEY, some(lambda x: F.lit(True)).alias("ordered"), some(always).alias("ident"), some(lambda x: (x["part"] == "dims") & ~x["always_on"]).alias("timbre"),
        some(lambda x: x["part"] == "emotions").alias("emo"), some(lambda x: x["part"] == "quality").alias("q"),
        F.filter(F.transform("r", lambda x: x["tag"]), lambda t: t.isNotNull() & (t != "")).alias("tags"),
        F.map_from_entries(F.transform(F.filter("r", lambda x: always(x) & x["phrase"].isNotNull()), lambda x: F.struct(x["dim"], x["phrase"]))).alias("idmap"),
    )


def _part(lead: str, items: Column, sep: str, end: str = ".", cap: bool = False) -> Column:
    """lead + items + end; null without items."""
    body = F.array_join(items, sep)
    return F.when(F.size(items) > 0, F.concat(F.lit(lead), first_upper(body) if cap else body, F.lit(end)))


def _some(*cols: Column) -> Column:
    return F.array_compact(F.array(*cols))


def template_texts() -> dict[str, Column]:
    """The text of each form as a column over groups()."""
    c = F.col
    body = F.concat(c("timbre"), c("ident"))
    both = F.concat(c("emo"), c("q"))
    ident = lambda d: c("idmap")[d]
    lead = F.concat_ws(" ", ident("AGEV"), ident("GEND"))
    tail = _some(ident("REGS"), ident("TEMP"))
    sounds = F.concat(F.when(lead != "", F.concat(F.lit("Sounds like a "), lead, F.lit(" voice"))).otherwise("Sounds like a voice"), F.coalesce(_part(", ", tail, ", ", ""), F.lit("")), F.lit("."))
    minimal = F.concat(F.when(lead != "", F.concat(F.lit("A "), lead, F.lit(" voice"))).otherwise("A voice"), F.coalesce(_part(" ", c("emo"), ", ", ""), F.lit("")), F.lit("."))
    links = F.array(*map(F.lit, (", with ", " and ", ", carrying ", ", ")))
    linked = F.concat(F.lit("A voice that is "), c("ordered")[0], F.array_join(F.transform(F.slice("ordered", 2, F.greatest(F.size("ordered"), F.lit(1))), lambda p, i: F.concat(F.element_at(links, F.pmod(i, F.lit(4)) + 1), p)), ""), F.lit("."))
    quality = _part("", c("q"), "; ", cap=True)
    emotional = _part("Emotionally, ", c("emo"), ", ")
    return {
        "default": _part("A voice that is ", c("ordered"), "; "),
        "identity_first": F.concat_ws(" ", _part("", c("ident"), ", ", cap=True), _part("It sounds ", c("timbre"), "; "), _part("Emotionally, it is ", c("emo"), ", "), quality),
        "emotion_first": F.concat_ws(" ", F.coalesce(_part("Emotionally ", c("emo"), ", "), F.lit("Emotionally even and unmarked.")), _part("The voice itself is ", body, "; "), quality),
        "telegraphic": _part("", c("ordered"), ", ", cap=True),
        "two_sentence": F.concat_ws(" ", _part("How it sounds: ", body, "; "), F.coalesce(_part("What it conveys: ", both, "; "), F.lit("What it conveys: little overt emotion."))),
        "sounds_like": F.concat_ws(" ", sounds, _part("It is ", c("timbre"), "; "), emotional, quality),
        "bulleted": F.concat(F.concat_ws(" · ", _part("Identity: ", c("ident"), ", ", ""), _part("Timbre: ", c("timbre"), "; ", ""), _part("Emotion: ", c("emo"), ", ", ""), _part("Delivery: ", c("q"), "; ", "")), F.lit(".")),
        "varied_connectors": linked,
        "quality_led": F.concat_ws(" ", F.coalesce(quality, F.lit("Natural, unforced in delivery.")), _part("The voice is ", body, "; "), emotional),
        "minimal_identity": F.concat_ws(" ", minimal, _part("Also ", F.concat(tail, c("timbre"), c("q")), ", ")),
        "tags": F.when(F.size("tags") > 0, F.array_join("tags", ", ")).otherwise("unremarkable"),
    }


def render(detail: DataFrame, template: str | Column = "default", entities: DataFrame | None = None) -> DataFrame:
    """(entity_id, template, text).  An unknown template is the default one; an entity without any phrase gets one fixed sentence.

    template may be a column of entity_id or of entities: (entity_id, ...) of all that should appear, also those without a row in detail.
    """
    g = groups(detail)
    if entities is not None:
        empty = F.array().cast("array<string>")
        g = entities.join(g, KEY, "left").withColumns({c: F.coalesce(c, empty) for c in ("ordered", "ident", "timbre", "emo", "q", "tags")})
    name = F.lit(template) if isinstance(template, str) else template
    name = F.when(name.isin(list(TEMPLATES)), name).otherwise("default")
    texts = template_texts()
    if isinstance(template, str):
        text = texts.get(template, texts["default"])
    else:
        text = F.lit(None).cast("string")
        for t, c in texts.items():
            text = F.when(F.col("template") == t, c).otherwise(text)
    return g.withColumn("template", name).select(KEY, "template", F.when(F.size("ordered") == 0, NOTHING).otherwise(text).alias("text"))


def sentence_cue(detail: DataFrame, template: str | Column = "tags", entities: DataFrame | None = None) -> DataFrame:
    """(entity_id, cue): tags, or one sentence from the phrases, of dims and emotions only."""
    g = groups(detail.filter("part <> 'quality'"))
    if entities is not None:
        g = entities.join(g, KEY, "left")
    t = F.lit(template) if isinstance(template, str) else template
    tags = F.coalesce(F.nullif(F.array_join("tags", ", "), F.lit("")), F.lit("unremarkable"))
    said = F.coalesce(_part("Delivered ", F.col("ordered"), "; "), F.lit("An even, unremarkable delivery."))
    return g.select(KEY, F.when(t == "tags", tags).otherwise(said).alias("cue"))
