"""Which deviations of an entity are described: layout, z-scores, gates, top-k, always-on dimensions, words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..model import NEUTRAL, Config, Lexicon
from ..sources import stages

KEY = "entity_id"


def normalise_layout(records: DataFrame, baseline: DataFrame) -> DataFrame:
    """(entity_id, grp, dim, dim_ix, cell) from records (entity_id, preds: JSON object text), nested or flat.

    Nested if `dims` or `emo` is an object.  Flat keys: genuineness or genu, blend, dims of the baseline's emotion group, all else dims.  A
    `genuineness` among dims moves up if genu is missing.  dim_ix keeps the order of the document.
    """
    obj = lambda c, path: F.from_json(F.get_json_object(c, path), "map<string,string>")
    p = F.col("preds")
    nested = F.coalesce(obj(p, "$.dims"), obj(p, "$.emo")).isNotNull()
    dims = F.when(nested, obj(p, "$.dims")).otherwise(F.from_json(p, "map<string,string>"))
    order = F.json_object_keys(F.when(nested, F.get_json_object(p, "$.dims")).otherwise(p))
    rows = records.select(KEY, nested.alias("nested"), dims.alias("m"), F.coalesce(order, F.array().cast("array<string>")).alias("k"), obj(p, "$.emo").alias("e"), F.json_object_keys(F.get_json_object(p, "$.emo")).alias("ek"), F.get_json_object(p, "$.genu").alias("genu"), F.get_json_object(p, "$.blend").alias("blend"))
    emotions = stages.small(stages.once(baseline.filter("grp = 'emotion'").select("dim", F.lit(True).alias("is_emotion")), "emotions"))
    flat = rows.select(KEY, "nested", "genu", F.posexplode("k").alias("dim_ix", "dim"), "m").select(KEY, "nested", "genu", "dim_ix", "dim", F.col("m")[F.col("dim")].alias("cell")).join(emotions, "dim", "left")
    is_genu = (F.col("dim") == "genuineness") | (~F.col("nested") & (F.col("dim") == "genu"))
    grp = F.when(is_genu & (F.col("genu").isNull() | ~F.col("nested")), "genu").when(is_genu, None).when(~F.col("nested") & (F.col("dim") == "blend"), "blend").when(~F.col("nested") & F.coalesce("is_emotion", F.lit(False)), "emo").otherwise("dims")
    out = flat.withColumn("grp", F.when(F.col("nested") & (F.col("dim") == "genuineness") & F.col("genu").isNotNull(), "dims").otherwise(grp)).select(KEY, "grp", "dim", "dim_ix", "cell")
    emo = rows.filter("nested and e is not null").select(KEY, F.posexplode("ek").alias("dim_ix", "dim"), "e").select(KEY, F.lit("emo").alias("grp"), "dim", "dim_ix", F.col("e")[F.col("dim")].alias("cell"))
    one = lambda c, g: rows.filter(F.col("nested") & F.col(c).isNotNull()).select(KEY, F.lit(g).alias("grp"), F.lit(g).alias("dim"), F.lit(0).alias("dim_ix"), F.col(c).alias("cell"))
    return out.unionByName(emo).unionByName(one("genu", "genu")).unionByName(one("blend", "blend"))


def with_z(scores: DataFrame, baseline: DataFrame) -> DataFrame:
    """Scores joined with their dimension's baseline row: z, name and synonyms added.

    Dimensions without one, or of another group, drop out, and so do null, NaN and infinite values: they pass no threshold.
    The baseline is computed once, as a stage table, and broadcast if it is found small.
    """
    given = {"name": F.lit(None).cast("string"), "synonyms": F.lit(None).cast("array<string>")}
    b = baseline.select("grp", "dim", "median", "std", "mad", "spread", *[F.col(c) if c in baseline.columns else none.alias(c) for c, none in given.items()])
    b = stages.small(stages.once(b, "baseline"))
    z = S.zscore(F.col("value"), F.col("median"), S.spread(F.col("spread"), F.col("mad"), F.col("std")))
    return scores.filter(S.is_finite(F.col("value"))).join(b, ["grp", "dim"]).withColumn("z", z)


def described(z: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Only dimensions with words."""
    return z.filter(F.col("dim").isin(sorted({*lexicon.dims, *lexicon.bands})))


def confidence_gate(z: DataFrame, experts: DataFrame, cfg: Config) -> DataFrame:
    """The gated dimension goes where its expert is known and near zero, before anything is ranked.  experts: (entity_id, expert)."""
    if cfg.confidence_gate <= 0:
        return z
    weak = F.col("expert").isNotNull() & (F.abs("expert") < cfg.confidence_gate) & (F.col("dim") == cfg.gated_dim)
    return z.join(experts.select(KEY, "expert"), KEY, "left").filter(~F.coalesce(weak, F.lit(False))).drop("expert")


def by_size(*keys: str) -> Window:
    """Largest |z| first; ties in input order."""
    return Window.partitionBy(*keys).orderBy(F.abs("z").desc(), F.col("dim_ix"))


def top_k(z: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k largest deviations of each entity, with their rank; k below 0 counts as 0."""
    return z.withColumn("rk", F.row_number().over(by_size(*(keys or (KEY,))))).filter(F.col("rk") <= max(0, k))


def _place(always_on: Sequence[str]) -> Column:
    """The place of a dimension in the always-on list, from 1."""
    place = F.lit(0)
    for i, d in enumerate(always_on):
        place = F.when(F.col("dim") == d, i + 1).otherwise(place)
    return place


def _always_on(always_on: Sequence[str]) -> Column:
    return F.col("dim").isin(list(always_on)) if always_on else F.lit(False)


def with_always_on(z: DataFrame, k: int, always_on: Sequence[str]) -> DataFrame:
    """The top k, flagged if always on, and after them the always-on dimensions that did not get there, in their own order."""
    r = z.withColumn("rk", F.row_number().over(by_size(KEY))).withColumn("always_on", _always_on(always_on))
    r = r.filter((F.col("rk") <= max(0, k)) | F.col("always_on"))
    return r.withColumn("pos", F.when(F.col("rk") <= max(0, k), F.col("rk")).otherwise(max(0, k) + _place(always_on))).drop("rk")


_PARTS = ("_tier", "_level", "_words", "_synonym")  # what texts are made of


def _with_level(rows: DataFrame, lexicon: Lexicon, tier: Column) -> DataFrame:
    """_tier, and _level: the number of a banded dimension's level, null beyond all bounds."""
    level = F
    for i in range(max(map(len, lexicon.bands.values()), default=0)):
        level = level.when(F.col("value") < F.get("_bounds", F.lit(i)), i)
    bounds = S.by_dim(F.col("dim"), {k: [b for b, _ in v] for k, v in lexicon.bands.items()}, "array<double>")
    return rows.withColumn("_bounds", bounds).withColumns({"_tier": tier, "_level": F.lit(None).cast("int") if level is F else level}).drop("_bounds")


def _words(lexicon: Lexicon) -> Column:
    return S.by_dim(F.col("dim"), lexicon.dims, "array<string>")


def _dim_columns(lexicon: Lexicon) -> dict[str, Column]:
    """Needs the parts as columns."""
    d, z, tier = F.col("dim"), F.col("z"), F.col("_tier")
    banded = d.isin(sorted(lexicon.bands)) if lexicon.bands else F.lit(False)
    at = lambda high, low: F.get("_words", F.when(z >= 0, high).otherwise(low))
    band = F.get(S.by_dim(d, {k: [w for _, w in v] for k, v in lexicon.bands.items()}, "array<string>"), F.col("_level"))
    band_tag = F.get(S.by_dim(d, lexicon.band_tags, "array<string>"), F.col("_level"))
    average = F.abs(z) < NEUTRAL
    word, tag = at(0, 1), at(2, 3)
    return {
        "direction": S.direction(z),
        "intensity": F.when(banded, "Absolute").when(average, "About-average").otherwise(tier),
        "phrase": F.when(banded, band).when(average, F.coalesce(S.by_dim(d, dict(lexicon.neutral)), F.concat(F.lit("average in "), F.lower(d)))).otherwise(F.concat(F.lower(tier), F.lit(" "), word)),
        "tag": F.when(banded, band_tag).when(average, F.lit(None).cast("string")).otherwise(S.short_tag(tier, tag)),
    }


def dim_words(sel: DataFrame, lexicon: Lexicon) -> DataFrame:
    """direction, intensity, phrase and tag of chosen dimensions."""
    return _with_level(sel, lexicon, S.tier(F.col("z"))).withColumn("_words", _words(lexicon)).withColumns(_dim_columns(lexicon)).drop(*_PARTS)


def genuineness(quality: DataFrame) -> DataFrame:
    """(entity_id, gate, descriptor, zg, g) from the z rows of the quality group."""
    g = quality.filter("dim = 'genuineness'")
    return g.select(KEY, S.gate(F.col("value"), F.col("median"), F.col("z")).alias("gate"), S.genuine_phrase(F.col("z")).alias("descriptor"), F.col("z").alias("zg"), F.col("value").alias("g"))


def _synonym(seed: Column) -> Column:
    n = F.size("synonyms")
    return F.when(n > 0, F.get("synonyms", F.pmod(S.draw(seed, "synonym", F.col("dim")), n).cast("int"))).otherwise(F.lower("dim"))


def _emotion_columns() -> dict[str, Column]:
    """Needs the parts as columns."""
    z, t, word = F.col("z"), F.col("_tier"), F.col("_synonym")
    return {"synonym": word, "intensity": t, "direction": S.direction(z), "phrase": S.emotion_phrase(z, t, word), "tag": S.emotion_tag(z, t, word)}


def emotion_words(z: DataFrame, gates: DataFrame, k: int, seed: Column) -> DataFrame:
    """The emotions of each entity: none behind a dropped gate; the top k, of which those near average then go; words by seed."""
    gated = z.join(gates.select(KEY, "gate"), KEY, "left").withColumn("gate", F.coalesce("gate", F.lit("open"))).filter("gate <> 'dropped'")
    return top_k(gated, k).filter(F.abs("z") >= NEUTRAL).withColumnRenamed("rk", "pos").withColumns({"_tier": S.tier(F.col("z"), F.col("gate") == "capped"), "_synonym": _synonym(seed)}).withColumns(_emotion_columns()).drop(*_PARTS)


def _quality_columns() -> dict[str, Column]:
    z, g = F.col("z"), F.col("dim") == "genuineness"
    return {"pos": F.when(g, 1).otherwise(2), "phrase": F.when(g, S.genuine_phrase(z)).otherwise(S.blend_phrase(z)), "tag": F.when(g, S.genuine_tag(z)).otherwise(S.blend_tag(z))}


def _quality_shown() -> Column:
    return (F.col("dim") == "genuineness") | ((F.col("dim") == "blend") & (F.abs("z") >= NEUTRAL))


def quality_words(quality: DataFrame) -> DataFrame:
    """Genuineness, and blend unless it is near average."""
    return quality.filter(_quality_shown()).withColumns(_quality_columns())


def detail(scores: DataFrame, baseline: DataFrame, lexicon: Lexicon, cfg: Config, seed: Column | None = None, experts: DataFrame | None = None, shuffle: bool | Column = False) -> DataFrame:
    """The long form of an entity's description: (entity_id, part, pos, dim, name, value, z, direction, intensity, always_on, phrase, tag).

    scores: (entity_id, grp, dim, dim_ix, value) with groups trait, emotion and quality.  Parts come in the order dims, emotions, quality.
    seed: a column of the scores or a literal; shuffle: whether all entities are shuffled, or a column of the scores that says which.
    The exact z decides; z and value are rounded at the end.

    One pass: scores meet the baseline once and are shuffled and sorted once, by entity and size; the gate and the ranks of all groups are windows
    over that order.  Tiers and levels are found between the two, so that each method that Spark generates is small enough for the JVM to compile.
    """
    seed = F.lit(0) if seed is None else seed
    grp, dim, z = F.col("grp"), F.col("dim"), F.col("z")
    trait, emotion, quality = (grp == g for g in ("trait", "emotion", "quality"))
    rows = with_z(scores, baseline).filter((trait & dim.isin(sorted({*lexicon.dims, *lexicon.bands}))) | emotion | (quality & dim.isin("genuineness", "blend")))
    if experts is not None and cfg.confidence_gate > 0:
        weak = F.col("expert").isNotNull() & (F.abs("expert") < cfg.confidence_gate) & trait & (dim == cfg.gated_dim)
        rows = rows.join(experts.select(KEY, "expert"), KEY, "left").filter(~F.coalesce(weak, F.lit(False))).drop("expert")
    rows, largest = rows.withColumn("_size", F.abs("z")), (F.desc("_size"), F.asc("dim_ix"))
    gate = F.max(F.when(quality & (dim == "genuineness"), S.gate(F.col("value"), F.col("median"), z))).over(Window.partitionBy(KEY).orderBy("grp", *largest).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("gate", F.coalesce(gate, F.lit("open"))).filter(~emotion | (F.col("gate") != "dropped"))
    rows = _with_level(rows, lexicon, S.tier(z, emotion & (F.col("gate") == "capped")))
    rows = rows.withColumns({"rk": F.row_number().over(Window.partitionBy(KEY, "grp").orderBy(*largest)), "always_on": trait & _always_on(cfg.always_on)})
    k = max(0, cfg.k_dims)
    shown = F.when(trait, (F.col("rk") <= k) | F.col("always_on")).when(emotion, (F.col("rk") <= max(0, cfg.k_emotions)) & (F.abs(z) >= NEUTRAL)).otherwise(_quality_shown())
    part = {"trait": (1, "dims"), "emotion": (2, "emotions"), "quality": (3, "quality")}
    of = lambda cells: F.when(trait, cells[0]).when(emotion, cells[1]).otherwise(cells[2])
    rows = rows.filter(shown).withColumns({"_words": _words(lexicon), "_synonym": F.when(emotion, _synonym(seed))})
    dims, emotions, qual = _dim_columns(lexicon), _emotion_columns(), _quality_columns()
    dims["pos"] = F.when(F.col("rk") <= k, F.col("rk")).otherwise(k + _place(cfg.always_on))
    emotions["pos"] = F.col("rk")
    none = F.lit(None).cast("string")
    moves = shuffle if isinstance(shuffle, Column) else F.lit(True) if shuffle else None
    drawn = []
    if moves is not None:
        movable = F.coalesce(moves, F.lit(False)) & ~quality & ~F.col("always_on")
        drawn = [movable.alias("mv"), F.when(trait, S.draw(seed, "dims", dim)).otherwise(S.draw(seed, "emotions", dim)).alias("drawn")]
    rows = rows.select(
        KEY, of([F.lit(i) for i, _ in part.values()]).alias("part_ix"), of([F.lit(n) for _, n in part.values()]).alias("part"), of([x["pos"].cast("int") for x in (dims, emotions, qual)]).alias("pos"), "dim",
        F.coalesce("name", "dim").alias("name"), "value", "z", *(of([x.get(c, none) for x in (dims, emotions, qual)]).alias(c) for c in ("direction", "intensity")), "always_on", *(of([x[c] for x in (dims, emotions, qual)]).alias(c) for c in ("phrase", "tag")), *drawn,
    )
    if moves is not None:
        # the movable rows of a part are dealt anew over the places that they hold
        own = Window.partitionBy(KEY, "part", "mv")
        rows = rows.withColumns({"slots": F.array_sort(F.collect_list("pos").over(own)), "i": F.row_number().over(own.orderBy("drawn", "dim"))})
        rows = rows.withColumn("pos", F.when(F.col("mv"), F.element_at("slots", F.col("i"))).otherwise(F.col("pos"))).drop("mv", "drawn", "slots", "i")
    return rows.withColumns({"value": F.round("value", 3), "z": F.round("z", 2)})


def shuffle_positions(rows: DataFrame, seed: Column, salt: str, movable: Column | None = None) -> DataFrame:
    """Deals the movable rows of each entity anew over the places that they hold; the others keep theirs."""
    movable = F.lit(True) if movable is None else movable
    r = rows.withColumn("mv", movable)
    slots = r.filter("mv").select(KEY, F.col("pos").alias("slot"), F.row_number().over(Window.partitionBy(KEY).orderBy("pos")).alias("i"))
    drawn = r.filter("mv").withColumn("i", F.row_number().over(Window.partitionBy(KEY).orderBy(S.draw(seed, salt, F.col("dim")), F.col("dim"))))
    moved = drawn.join(slots, [KEY, "i"]).drop("pos", "i").withColumnRenamed("slot", "pos")
    return r.filter("not mv").unionByName(moved).drop("mv")
