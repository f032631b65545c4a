"""Registered queries of the data flow, each with its SQL twin.  Keys begin with the operator's number in the survey."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..model import BURST_PHRASES, TEMPLATES, Config
from ..operators import evaluate, filters, infer, placement, records, render, seeded, select, spans, stats
from ..sources import stages
from . import demo, twins as T
from .demo import CFG, EVENT_CFG, LEXICON, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            TWINS[name] = sql
        return f

    return add


# ---- baseline ----
_LI = "li AS (SELECT unnest(['QTY', 'PRICE', 'DISC', 'TAX']) AS dim, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem)"
_STATS = "dim, mean, median, std, mad, spread, p10, p90, n"


@query("a01_baseline_lineitem", f"WITH {_LI}, {T.stats('li')} SELECT {_STATS} FROM stats")
def a01_lineitem(spark, sf):
    c = F.col
    return stats.baseline_stats(stats.melt(table(spark, sf, "lineitem"), [], {"QTY": c("l_quantity"), "PRICE": c("l_extendedprice"), "DISC": c("l_discount"), "TAX": c("l_tax")}))


@query("a01_baseline_distributed", f"WITH {_LI}, {T.stats('li')} SELECT {_STATS} FROM stats")
def a01_distributed(spark, sf):
    c = F.col
    scores = stats.melt(table(spark, sf, "lineitem"), [], {"QTY": c("l_quantity"), "PRICE": c("l_extendedprice"), "DISC": c("l_discount"), "TAX": c("l_tax")})
    return stats.baseline_stats(scores, distributed=True)


@query("a01_baseline_events", f"WITH ev AS (SELECT event_type AS dim, value FROM events), {T.stats('ev')} SELECT {_STATS} FROM stats")
def a01_events(spark, sf):
    return stats.baseline_stats(table(spark, sf, "events").select(F.col("event_type").alias("dim"), "value"))


@query("a02_spread_rule", "WITH e AS (SELECT event_type AS dim, CASE WHEN event_id % 3 = 0 THEN value ELSE 0.0 END AS value FROM events), " + T.stats("e") + " SELECT dim, std, mad, spread FROM stats")
def a02_spread(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("dim"), F.when(F.pmod("event_id", F.lit(3)) == 0, F.col("value")).otherwise(0.0).alias("value"))
    return stats.baseline_stats(e).select("dim", "std", "mad", "spread")


_TWO = f"""WITH p1 AS (SELECT 'BALANCE' AS dim, c_acctbal AS value FROM customer), p2 AS (SELECT unnest(['BALANCE', 'ONLY_SECOND']) AS dim, s_acctbal AS value FROM supplier),
u AS (SELECT dim, value, 1 AS src FROM p1 UNION ALL SELECT dim, value, 2 FROM p2 WHERE dim IN (SELECT dim FROM p1)),
c AS (SELECT dim, count(*) FILTER (WHERE src = 1) AS n_primary, count(*) FILTER (WHERE src = 2) AS n_secondary FROM u WHERE value IS NOT NULL GROUP BY dim), {T.stats('u')}
SELECT {_STATS}, n_primary, n_secondary FROM stats JOIN c USING (dim)"""


@query("j05_baseline_two_source", _TWO)
def j05_two_source(spark, sf):
    first = table(spark, sf, "customer").select(F.lit("BALANCE").alias("dim"), F.col("c_acctbal").alias("value"))
    second = stats.melt(table(spark, sf, "supplier"), [], {"BALANCE": F.col("s_acctbal"), "ONLY_SECOND": F.col("s_acctbal")})
    return stats.two_source_stats(first, second)


@query("k02_baseline_document", f"WITH {T.SCORES}, {T.stats('scores', 'grp')} SELECT dim, {T._NAME.replace('b.dim', 'dim')} AS name, grp, median, spread, n FROM stats")
def k02_document(spark, sf):
    return demo.supplier_baseline(demo.supplier_scores(spark, sf)).select("dim", "name", "grp", "median", "spread", "n").orderBy("dim")


@query("a03_source_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def a03_counts(spark, sf):
    return stats.source_counts(table(spark, sf, "documents"), "lang", "source")


@query("a04_distinct", "SELECT count(DISTINCT p_brand) AS n, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS names FROM part")
def a04_distinct(spark, sf):
    return stats.sorted_distinct(table(spark, sf, "part"), "p_brand").withColumn("names", F.array_join("names", ","))


@query("a04_distinct_numbered", "SELECT row_number() OVER (ORDER BY l_partkey) - 1 AS pos, l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem)")
def a04_numbered(spark, sf):
    return stats.numbered_distinct(table(spark, sf, "lineitem"), "l_partkey")


@query("f09_finite_filter", "SELECT count(*) AS n, round(avg(v), 4) AS mean FROM (SELECT CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 'Infinity'::DOUBLE ELSE value END AS v FROM events) WHERE v IS NOT NULL AND NOT isnan(v) AND NOT isinf(v)")
def f09_finite(spark, sf):
    m = F.pmod("event_id", F.lit(5))
    v = F.when(m == 1, float("nan")).when(m == 2, float("inf")).when(m > 2, F.col("value"))
    return stats.finite(table(spark, sf, "events").select(v.alias("value"))).agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


# ---- scores and words ----
def _scores(spark, sf):
    """Read by the baseline and by the z-scores."""
    return stages.once(demo.supplier_scores(spark, sf), "scores")


def _z(spark, sf):
    s = _scores(spark, sf)
    return select.with_z(s, demo.supplier_baseline(s))


@query("p05_zscore", f"WITH {T.Z} SELECT entity_id, dim, round(value, 3) AS value, round(z, 2) AS z FROM z")
def p05_z(spark, sf):
    return _z(spark, sf).select("entity_id", "dim", F.round("value", 3).alias("value"), F.round("z", 2).alias("z"))


@query("p06_intensity", f"WITH {T.Z} SELECT entity_id, dim, {T.TIER} AS intensity, CASE WHEN abs(z) >= 1.0 THEN 'Notably' ELSE 'Somewhat' END AS capped, CASE WHEN z >= 0 THEN 'above' ELSE 'below' END AS direction FROM z")
def p06_intensity(spark, sf):
    z = F.col("z")
    return _z(spark, sf).select("entity_id", "dim", S.tier(z).alias("intensity"), S.tier(z, F.lit(True)).alias("capped"), S.direction(z).alias("direction"))


_BANDS = ((10.0, "tiny"), (20.0, "small"), (30.0, "medium"), (40.0, "large"), (99.0, "huge"))


@query("p08_absolute_bands", "SELECT p_partkey, CASE " + " ".join(f"WHEN p_size < {b} THEN '{w}'" for b, w in _BANDS) + " END AS band FROM part")
def p08_bands(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.level(F.col("p_size").cast("double"), *zip(*_BANDS)).alias("band"))


@query("p09_neutral", f"WITH {T.Z}, t AS (SELECT *, {T.DIM_WORDS} FROM z WHERE grp = 'trait') SELECT entity_id, dim, direction, intensity, phrase, tag FROM t")
def p09_words(spark, sf):
    return select.dim_words(_z(spark, sf).filter("grp = 'trait'"), LEXICON).select("entity_id", "dim", "direction", "intensity", "phrase", "tag")


@query("p14_genuineness", f"WITH {T.Z}, {T.QUALITY} SELECT entity_id, dim, phrase, tag FROM qual")
def p14_quality(spark, sf):
    return select.quality_words(_z(spark, sf).filter("grp = 'quality'")).select("entity_id", "dim", "phrase", "tag")


@query("f03_quality_gate", f"WITH {T.Z} SELECT entity_id, {T.GATE} AS gate, {T.GENUINE_PHRASE} AS descriptor, round(z, 2) AS zg FROM z WHERE dim = 'genuineness'")
def f03_gate(spark, sf):
    return select.genuineness(_z(spark, sf).filter("grp = 'quality'")).select("entity_id", "gate", "descriptor", F.round("zg", 2).alias("zg"))


@query("w01_topk", f"WITH {T.Z}, {T.selection(5, ())} SELECT entity_id, dim, rk, round(z, 2) AS z FROM sel")
def w01_topk(spark, sf):
    return select.top_k(select.described(_z(spark, sf).filter("grp = 'trait'"), LEXICON), 5).select("entity_id", "dim", F.col("rk").cast("bigint").alias("rk"), F.round("z", 2).alias("z"))


@query("j03_always_on", f"WITH {T.Z}, {T.selection(3)} SELECT entity_id, dim, pos::INT AS pos, always_on FROM sel")
def j03_always(spark, sf):
    return select.with_always_on(select.described(_z(spark, sf).filter("grp = 'trait'"), LEXICON), 3, CFG.always_on).select("entity_id", "dim", F.col("pos").cast("int").alias("pos"), "always_on")


@query("f04_confidence_gate", f"WITH {T.Z}, {T.EXPERTS}, {T.selection(5, gated=True)} SELECT entity_id, dim, pos::INT AS pos, always_on FROM sel")
def f04_confidence(spark, sf):
    z = select.confidence_gate(select.described(_z(spark, sf).filter("grp = 'trait'"), LEXICON), demo.experts(spark, sf), CFG)
    return select.with_always_on(z, 5, CFG.always_on).select("entity_id", "dim", F.col("pos").cast("int").alias("pos"), "always_on")


@query("f02_neutral_drop", f"WITH {T.Z}, {T.emotions(3)} SELECT entity_id, dim, pos::INT AS pos, gate, synonym, intensity, phrase, tag FROM emo")
def f02_emotions(spark, sf):
    z = _z(spark, sf)
    e = select.emotion_words(z.filter("grp = 'emotion'"), select.genuineness(z.filter("grp = 'quality'")), 3, F.lit(0))
    return e.select("entity_id", "dim", F.col("pos").cast("int").alias("pos"), "gate", "synonym", "intensity", "phrase", "tag")


def _detail(spark, sf, cfg: Config = CFG, seed=None, gated=False, shuffle=False):
    s = _scores(spark, sf)
    return select.detail(s, demo.supplier_baseline(s), LEXICON, cfg, seed, demo.experts(spark, sf) if gated else None, shuffle)


_COLUMNS = "entity_id, part, pos, dim, name, value, z, direction, intensity, always_on, phrase, tag"


@query("j01_detail", f"{T.detail()} SELECT {_COLUMNS} FROM detail")
def j01_detail(spark, sf):
    return _detail(spark, sf).select(*_COLUMNS.split(", "))


@query("f04_detail_gated", f"{T.detail(gated=True)} SELECT {_COLUMNS} FROM detail")
def f04_detail(spark, sf):
    return _detail(spark, sf, gated=True).select(*_COLUMNS.split(", "))


@query("k07_detail_json", f"{T.detail()} SELECT entity_id, count(*) AS n, count(*) FILTER (WHERE part = 'dims') AS n_dims, count(*) FILTER (WHERE part = 'emotions') AS n_emotions FROM detail GROUP BY entity_id")
def k07_json(spark, sf):
    d = _detail(spark, sf)
    j = d.groupBy("entity_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("part_ix", "pos", "part", "dim", "phrase", "tag")))).alias("j"))
    rows = F.from_json("j", "array<struct<part:string>>")
    n = lambda p: F.size(F.filter(rows, lambda x: x["part"] == p)).cast("bigint")
    return j.select("entity_id", F.size(rows).cast("bigint").alias("n"), n("dims").alias("n_dims"), n("emotions").alias("n_emotions"))


# ---- texts ----
def _text(name: str) -> Query:
    return lambda spark, sf: render.render(_detail(spark, sf), name)


for _i, _t in enumerate(TEMPLATES):
    query(f"x{_i + 1:02d}_{_t}", T.render(_t))(_text(_t))

_PICK = T.pick(TEMPLATES, T.draw("entity_id", "template"))


@query("x12_dispatch", f"{T.detail()},\n{T.GROUPS},\nh AS (SELECT *, CASE entity_id % 3 WHEN 0 THEN {_PICK} WHEN 1 THEN 'tags' ELSE 'default' END AS template FROM g) SELECT entity_id, template, {T.any_template('template')} AS text FROM h")
def x12_dispatch(spark, sf):
    asked = F.when(F.pmod("entity_id", F.lit(3)) == 0, "random").when(F.pmod("entity_id", F.lit(3)) == 1, "tags").otherwise("no such form")
    return render.render(_detail(spark, sf), seeded.template_pick(asked, F.col("entity_id")))


_SENT = T.detail(3, 3, ()) + ", g AS (SELECT entity_id, string_agg(phrase, '; ' ORDER BY part_ix, pos) AS p, string_agg(tag, ', ' ORDER BY part_ix, pos) AS t FROM detail WHERE part <> 'quality' GROUP BY entity_id)"


@query("x13_sentence", f"{_SENT} SELECT entity_id, CASE WHEN entity_id % 2 = 0 THEN coalesce(t, 'unremarkable') ELSE coalesce('Delivered ' || p || '.', 'An even, unremarkable delivery.') END AS cue FROM g")
def x13_sentence(spark, sf):
    d = _detail(spark, sf, replace(CFG, k_dims=3, always_on=()))
    return render.sentence_cue(d, F.when(F.pmod("entity_id", F.lit(2)) == 0, "tags").otherwise("default"))


_HTML = """SELECT doc_id, regexp_replace(replace(replace(replace(replace(replace('(' || text || ')', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;'), '\\(([^)]+)\\)', '<span class="burst">(\\1)</span>', 'g') AS html FROM documents"""


@query("x18_html", _HTML)
def x18_html(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.emphasise(S.html_escape(F.concat(F.lit("("), F.col("text"), F.lit(")")))).alias("html"))


@query("x18_html_whole", _HTML.replace("doc_id", "page_id").replace("text", "html").replace("documents", "pages"))
def x18_pages(spark, sf):
    """Whole raw pages as text of another page."""
    return table(spark, sf, "pages").select("page_id", S.emphasise(S.html_escape(F.concat(F.lit("("), F.col("html"), F.lit(")")))).alias("html"))


# ---- seeded variation ----
@query("v01_template_pick", f"SELECT p_partkey, {T.pick(TEMPLATES, T.draw('p_partkey', 'template'))} AS template FROM part")
def v01_template(spark, sf):
    return table(spark, sf, "part").select("p_partkey", seeded.template_pick(F.lit("random"), F.col("p_partkey")).alias("template"))


@query("v02_synonym", f"WITH {T.Z}, {T.emotions(3, 'entity_id')} SELECT entity_id, dim, synonym FROM emo")
def v02_synonym(spark, sf):
    z = _z(spark, sf)
    return select.emotion_words(z.filter("grp = 'emotion'"), select.genuineness(z.filter("grp = 'quality'")), 3, F.col("entity_id")).select("entity_id", "dim", "synonym")


@query("v03_shuffle", f"{T.detail(seed='entity_id', shuffle=True)} SELECT entity_id, part, pos, dim, phrase FROM detail")
def v03_shuffle(spark, sf):
    return _detail(spark, sf, seed=F.col("entity_id"), shuffle=True).select("entity_id", "part", "pos", "dim", "phrase")


@query("v04_burst_phrase", f"SELECT event_id, replace({T.pick(BURST_PHRASES, T.draw('user_id', 'burst', 'event_type'))}, '{{b}}', event_type) AS phrase FROM events")
def v04_phrase(spark, sf):
    return table(spark, sf, "events").select("event_id", seeded.burst_phrase(F.col("event_type"), F.col("user_id")).alias("phrase"))


@query("v05_augment_draws", f"SELECT p_partkey, {T.pick(TEMPLATES, T.draw('p_partkey', 'augment-template'))} AS template, {T.draw('p_partkey', 'augment-synonym')} % 1073741824 AS synonym_seed, {T.draw('p_partkey', 'augment-shuffle')} < 2147483648 AS shuffle FROM part")
def v05_draws(spark, sf):
    t, s, c = seeded.augment_draws(F.col("p_partkey"))
    return table(spark, sf, "part").select("p_partkey", t.alias("template"), s.alias("synonym_seed"), c.alias("shuffle"))


@query("v08_epochs", "SELECT s_suppkey AS example_id, epoch::INT AS epoch, epoch * 1000003 + s_suppkey AS seed FROM supplier, (SELECT unnest(range(4)) AS epoch)")
def v08_epochs(spark, sf):
    return seeded.epochs(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("example_id")), 4)


@query("v09_clip_seed", f"SELECT c_custkey, {T.draw('0', 'clip', 'c_name')} % 1073741824 AS seed FROM customer")
def v09_seed(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", seeded.clip_seed(F.col("c_name")).alias("seed"))


_D = T.draw("0", "sample", "doc_id")


@query("r01_stratified_sample", f"SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {_D}, doc_id) AS rn FROM documents) WHERE rn <= 20")
def r01_stratified(spark, sf):
    return seeded.stratified_sample(table(spark, sf, "documents").select("lang", "doc_id"), "lang", "doc_id", 20)


@query("r02_sample", f"SELECT p_partkey FROM part ORDER BY {T.draw('0', 'sample', 'p_partkey')}, p_partkey LIMIT 100")
def r02_sample(spark, sf):
    return seeded.simple_sample(table(spark, sf, "part").select("p_partkey"), "p_partkey", 100)


@query("r03_two_level", f"""WITH s AS (SELECT lang, source FROM (SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY {T.draw('0', 'shard', 'source')}, source) AS sn FROM (SELECT DISTINCT lang, source FROM documents)) WHERE sn <= 3)
SELECT lang, source, doc_id FROM (SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY {T.draw('0', 'key', 'doc_id')}, doc_id) AS rn FROM documents JOIN s USING (lang, source)) WHERE rn <= 5""")
def r03_two_level(spark, sf):
    return seeded.two_level_sample(table(spark, sf, "documents").select("lang", "source", "doc_id"), "lang", "source", "doc_id", 3, 5)


@query("r04_first_shard", f"""WITH s AS (SELECT source FROM (SELECT source, count(*) AS m FROM documents GROUP BY source) WHERE m >= 10 ORDER BY {T.draw('0', 'shard', 'source')}, source LIMIT 1)
SELECT source, doc_id FROM documents WHERE source IN (SELECT source FROM s) ORDER BY {_D}, doc_id LIMIT 10""")
def r04_first(spark, sf):
    return seeded.first_shard_sample(table(spark, sf, "documents").select("source", "doc_id"), "source", "doc_id", 10)


# ---- nested input ----
@query("p01_layout_normalise", """WITH r AS (SELECT event_id, CASE event_id % 4 WHEN 3 THEN value END AS g, value AS v, user_id AS u, event_id % 2 = 0 AS nested FROM events)
SELECT event_id AS entity_id, 'dims' AS grp, 'A' AS dim, v AS value FROM r UNION ALL SELECT event_id, 'emo', 'JOY', u::DOUBLE FROM r UNION ALL SELECT event_id, 'genu', 'genuineness', 2.5 FROM r WHERE nested UNION ALL SELECT event_id, 'genu', 'genu', 1.5 FROM r WHERE NOT nested UNION ALL SELECT event_id, 'blend', 'blend', 3.0 FROM r""")
def p01_layout(spark, sf):
    e = table(spark, sf, "events")
    nested = F.to_json(F.struct(F.struct(F.col("value").alias("A"), F.lit(2.5).alias("genuineness")).alias("dims"), F.struct(F.col("user_id").alias("JOY")).alias("emo"), F.lit(3.0).alias("blend")))
    flat = F.to_json(F.struct(F.col("value").alias("A"), F.struct(F.col("user_id").alias("r")).alias("JOY"), F.lit(1.5).alias("genu"), F.struct(F.lit(3.0).alias("value"), F.lit(9).alias("r")).alias("blend")))
    recs = e.select(F.col("event_id").alias("entity_id"), F.when(F.pmod("event_id", F.lit(2)) == 0, nested).otherwise(flat).alias("preds"))
    base = spark.createDataFrame([("emotion", "JOY")], "grp string, dim string")
    return select.normalise_layout(recs, base).select("entity_id", "grp", "dim", S.scalar_cell(F.col("cell")).alias("value"))


@query("p03_unwrap", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN (props->>'$.k')::DOUBLE WHEN 1 THEN value WHEN 2 THEN user_id::DOUBLE WHEN 3 THEN NULL ELSE value END AS v FROM events""")
def p03_unwrap(spark, sf):
    v, k, m = F.col("value"), F.get_json_object("props", "$.k"), F.pmod("event_id", F.lit(5))
    cell = F.when(m == 0, k).when(m == 1, F.to_json(F.struct(v.alias("value"), F.lit(1).alias("reg")))).when(m == 2, F.to_json(F.struct(F.col("user_id").alias("r"), F.lit(7).alias("score")))).when(m == 3, F.col("props")).otherwise(v.cast("string"))
    return table(spark, sf, "events").select("event_id", S.scalar_cell(cell).alias("v"))


@query("f10_json_map", "SELECT 'k' AS dim, count(*) AS n, sum((props->>'$.k')::DOUBLE) AS total FROM events WHERE event_id % 3 <> 0")
def f10_map(spark, sf):
    broken = F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    e = filters.json_cells(table(spark, sf, "events"), broken)
    return e.groupBy("dim").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("f11_languages", "SELECT doc_id, lang FROM documents WHERE lower(lang) IN ('en', 'de')")
def f11_languages(spark, sf):
    return filters.of_languages(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ("EN", "de"))


@query("f12_key_set", "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def f12_keys(spark, sf):
    return filters.with_keys(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels").filter("quality = 1"), "doc_id")


@query("j11_synonyms", "SELECT l AS dim, coalesce(s, '') AS synonyms FROM (SELECT DISTINCT lang AS l FROM documents WHERE lang IS NOT NULL) LEFT JOIN (SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS s FROM documents WHERE lang <> 'de' GROUP BY lang) ON l = lang")
def j11_synonyms(spark, sf):
    d = table(spark, sf, "documents").select(F.col("lang").alias("dim"), "source").filter("dim is not null")
    words = d.filter("dim <> 'de'").groupBy("dim").agg(F.array_sort(F.collect_set("source")).alias("synonyms"))
    return filters.with_synonyms(d.select("dim").distinct(), words).select("dim", F.array_join("synonyms", ",").alias("synonyms"))


@query("p25_segments", """SELECT conv_id, turn, CASE WHEN ok THEN greatest(0.0, a - 0.1) ELSE 0.0 END AS a, CASE WHEN ok THEN least(30.0, b + 0.1) ELSE 30.0 END AS b FROM
(SELECT conv_id, turn, turn * 1.5::DOUBLE AS a, CASE WHEN turn % 3 <> 2 THEN turn * 1.5::DOUBLE + (conv_id % 4) - 1 END AS b, CASE WHEN turn % 3 <> 2 THEN (conv_id % 4) - 1 > 0 ELSE false END AS ok FROM conversations)""")
def p25_segments(spark, sf):
    a = F.col("turn") * 1.5
    b = F.when(F.pmod("turn", F.lit(3)) != 2, a + F.pmod("conv_id", F.lit(4)) - 1)
    x, y = S.segment(a, b, F.lit(30.0), CFG.pad)
    return table(spark, sf, "conversations").select("conv_id", "turn", x.alias("a"), y.alias("b"))


@query("p23_fit_length", "SELECT vec_id, round(list_sum(list_transform(v, lambda x: x::DOUBLE)), 4) AS total, len(v) AS n FROM (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN embedding[1:50] ELSE embedding || list_transform(range(36), lambda i: 0.0::FLOAT) END AS v FROM embeddings)")
def p23_fit(spark, sf):
    n = F.when(F.pmod("vec_id", F.lit(2)) == 0, 50).otherwise(100)
    v = F.col("embedding").cast("array<double>")
    both = F.when(n == 50, S.fit_length(v, 50)).otherwise(S.fit_length(v, 100))
    return table(spark, sf, "embeddings").select("vec_id", F.round(F.aggregate(both, F.lit(0.0), lambda t, x: t + x), 4).alias("total"), F.size(both).cast("bigint").alias("n"))


@query("p24_cut_samples", "SELECT vec_id, len(embedding[((vec_id % 5) * 10)::INT + 1 : ((vec_id % 5) * 10 + 12)::INT]) AS n, round(embedding[((vec_id % 5) * 10)::INT + 1]::DOUBLE, 5) AS first FROM embeddings")
def p24_cut(spark, sf):
    a = F.pmod("vec_id", F.lit(5)) * 1.0
    c = S.cut_samples(F.col("embedding"), a, a + 1.2, 10)
    return table(spark, sf, "embeddings").select("vec_id", F.size(c).cast("bigint").alias("n"), F.round(c[0].cast("double"), 5).alias("first"))


# ---- events in time ----
@query("w02_islands", f'WITH {T.FRAMES}, {T.ISLANDS} SELECT clip, start, "end", n_frames, peak FROM spans')
def w02_islands(spark, sf):
    return spans.islands(demo.event_frames(spark, sf), EVENT_CFG)


@query("a06_peak", f"WITH {T.FRAMES}, {T.ISLANDS} SELECT clip, count(*) AS n_spans, max(peak) AS peak FROM spans GROUP BY clip")
def a06_peak(spark, sf):
    return spans.islands(demo.event_frames(spark, sf), EVENT_CFG).groupBy("clip").agg(F.count("*").alias("n_spans"), F.max("peak").alias("peak"))


_TAX = [(i, f"C{i}", ("laughter", "tongue_clicks", "sighs", "mouth_and_lip_sounds")[i % 4]) for i in range(63)] + [(63, "no_burst", None)]
_TAX_SQL = "tax AS (SELECT i AS class_ix, 'C' || i AS class, (['laughter', 'tongue_clicks', 'sighs', 'mouth_and_lip_sounds'])[(i % 4 + 1)::INT] AS grp FROM (SELECT unnest(range(63)) AS i))"


def _classified(spark, sf, cfg=CFG):
    tax = spark.createDataFrame(_TAX, "class_ix int, class string, grp string")
    p = F.transform("embedding", lambda x: S.sigmoid(x.cast("double") * 4))
    e = table(spark, sf, "embeddings").select("vec_id", p.alias("scores"), F.lit(0.0).alias("start"), (F.pmod("vec_id", F.lit(12)) * 0.1).alias("end"))
    return spans.classify(e, tax, cfg, F.col("end") - F.col("start"))


_CLASS = f"""{_TAX_SQL}, e AS (SELECT vec_id, list_transform(embedding, lambda x: 1.0::DOUBLE / (1.0 + exp(-(x::DOUBLE * 4)))) AS p, (vec_id % 12) * 0.1 AS dur FROM embeddings),
c AS (SELECT vec_id, dur, p[64] AS nb, list_max(p[1:63]) AS best, list_position(p[1:63], list_max(p[1:63])) - 1 AS ix FROM e),
s AS (SELECT vec_id, dur::DOUBLE AS dur, CASE WHEN dur >= 0.1 AND nb < 0.5 THEN ix END AS ix, CASE WHEN dur < 0.1 THEN 0.0 WHEN nb < 0.5 THEN best ELSE nb END AS prob, CASE WHEN dur < 0.1 THEN 1.0 ELSE nb END AS p_noburst FROM c),
k AS (SELECT s.*, class AS label, grp FROM s LEFT JOIN tax ON ix = class_ix)"""


@query("a07_top1", f"WITH {_CLASS} SELECT vec_id, label, round(prob, 3) AS prob, round(p_noburst, 3) AS p_noburst FROM k")
def a07_top1(spark, sf):
    return _classified(spark, sf).select("vec_id", "label", F.round("prob", 3).alias("prob"), F.round("p_noburst", 3).alias("p_noburst"))


_FLOOR = f"CASE WHEN label IS NULL THEN 0.0 WHEN grp IN ({T.TRANSIENT_LIST}) THEN 0.6 ELSE 0.3 END"


@query("f07_duration_gate", f"WITH {_CLASS} SELECT vec_id, label, round(dur, 2) AS dur, ({_FLOOR})::DOUBLE AS dur_floor, label IS NOT NULL AND dur < {_FLOOR} AS dur_gated, label IS NOT NULL AND dur >= {_FLOOR} AS kept FROM k")
def f07_duration(spark, sf):
    return spans.duration_gate(_classified(spark, sf), CFG).select("vec_id", "label", "dur", "dur_floor", "dur_gated", "kept")


@query("a10_hits", f"WITH {_CLASS} SELECT grp, count(*) AS n_spans, count(*) FILTER (WHERE label IS NOT NULL AND dur >= {_FLOOR}) AS n_kept, count(*) FILTER (WHERE label IS NOT NULL AND dur < {_FLOOR}) AS n_gated, count(*) FILTER (WHERE label IS NULL) AS n_no_burst FROM k GROUP BY grp")
def a10_hits(spark, sf):
    return evaluate.span_counts(spans.duration_gate(_classified(spark, sf), CFG), "grp")


def _series(spark, sf):
    words = stages.once(demo.event_words(spark, sf), "words")
    return words, demo.sentences_of(words), demo.event_bursts(spark, sf)


_SER = f"{T.WORDS},\n{T.SENTENCES},\n{T.BURSTS}"


@query("j07_nearest_interval", f"WITH {_SER}, {T.PLACED} SELECT clip, b_ix, s_ix::INT AS s_ix FROM placed")
def j07_nearest(spark, sf):
    _, s, b = _series(spark, sf)
    return placement.bursts_to_sentences(b, s, EVENT_CFG).select("clip", "b_ix", "s_ix")


@query("j08_contain", f"WITH {_SER}, {T.CONTAINED} SELECT clip, s_ix::INT AS s_ix, ix::INT AS ix FROM inner_w")
def j08_contain(spark, sf):
    w, s, _ = _series(spark, sf)
    return placement.words_in_sentences(w, s).select("clip", "s_ix", "ix")


@query("j09_asof", f"WITH {_SER}, {T.slots('words', 'bursts', 'clip')} SELECT clip, b_ix, slot::INT AS slot FROM slots")
def j09_asof(spark, sf):
    w, _, b = _series(spark, sf)
    return placement.slots(placement.numbered(w, ["clip"]), b, ["clip"]).select("clip", "b_ix", F.col("slot").cast("int").alias("slot"))


@query("j10_overlap", f"""WITH {_SER} SELECT s.clip, s.ix::INT AS ix, coalesce(string_agg(b.label, ',' ORDER BY b.b_ix), '') AS bursts FROM sent s LEFT JOIN bursts b ON b.clip = s.clip AND (b.start + b."end") / 2 BETWEEN s.start - {EVENT_CFG.slack} AND s."end" + {EVENT_CFG.slack} GROUP BY s.clip, s.ix""")
def j10_overlap(spark, sf):
    _, s, b = _series(spark, sf)
    return placement.overlapping(b, s, EVENT_CFG).select("clip", "ix", F.array_join("bursts", ",").alias("bursts"))


@query("w03_gap", f"""WITH {T.WORDS}, g AS (SELECT clip, ix, start - lag(coalesce("end", start)) OVER (PARTITION BY clip ORDER BY ix) AS gap FROM words) SELECT clip, ix::INT AS ix, round(gap, 2) AS gap, gap >= {EVENT_CFG.pause} AS pause FROM g""")
def w03_gap(spark, sf):
    w = placement.numbered(demo.event_words(spark, sf), ["clip"])
    return placement.gaps(w, ["clip"], EVENT_CFG).select("clip", "ix", F.round("gap", 2).alias("gap"), (F.col("gap") >= EVENT_CFG.pause).alias("pause"))


@query("w04_last_nonnull_gap", f"""WITH {T.WORDS},\n{T.SENTENCES} SELECT clip, ix::INT AS ix, round(start - last_value("end" IGNORE NULLS) OVER (PARTITION BY clip ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 2) AS gap FROM sent""")
def w04_gap(spark, sf):
    return placement.sentence_gaps(demo.event_sentences(spark, sf)).select("clip", "ix", F.round("gap", 2).alias("gap"))


@query("x14_inline", f"WITH {_SER}, {T.slots('words', 'bursts', 'clip')},\n{T.inline('clip')} SELECT clip, text FROM inl")
def x14_inline(spark, sf):
    w, _, b = _series(spark, sf)
    return placement.inline(w, b, EVENT_CFG, ["clip"])


@query("x15_phrase", f"SELECT conv_id, turn, rtrim(text, '.') || ', ' || replace({T.pick(BURST_PHRASES, T.draw('conv_id', 'burst', 'role'))}, '{{b}}', role) || '.' AS text FROM conversations")
def x15_phrase(spark, sf):
    said = F.concat(placement.without_stops(F.col("text")), F.lit(", "), seeded.burst_phrase(F.col("role"), F.col("conv_id")), F.lit("."))
    return table(spark, sf, "conversations").select("conv_id", "turn", said.alias("text"))


@query("x16_script_line", f"WITH {T.SCRIPT} SELECT clip, ix::INT AS ix, text, bursts FROM lines")
def x16_lines(spark, sf):
    return placement.script_lines(*_series(spark, sf), EVENT_CFG).select("clip", "ix", "text", F.array_join("bursts", ",").alias("bursts"))


@query("x17_document", f"WITH {T.SCRIPT} SELECT clip, 'GENERAL: user ' || clip || chr(10) || 'SCRIPT:' || chr(10) || string_agg('(turn ' || ix || ') ' || text, chr(10) ORDER BY ix) AS document FROM lines GROUP BY clip")
def x17_document(spark, sf):
    lines = placement.script_lines(*_series(spark, sf), EVENT_CFG).withColumn("cue", F.concat(F.lit("turn "), F.col("ix").cast("string")))
    general = lines.select("clip").distinct().withColumn("text", F.concat(F.lit("user "), F.col("clip").cast("string")))
    return placement.document(general, lines)


@query("k08_score_record", f"""WITH {_SER}, o AS (SELECT s.clip, s.ix, count(b.label) AS nb FROM sent s LEFT JOIN bursts b ON b.clip = s.clip AND (b.start + b."end") / 2 BETWEEN s.start - {EVENT_CFG.slack} AND s."end" + {EVENT_CFG.slack} GROUP BY s.clip, s.ix)
SELECT clip, count(*) AS n_sentences, sum(nb)::BIGINT AS n_bursts FROM o GROUP BY clip""")
def k08_record(spark, sf):
    _, s, b = _series(spark, sf)
    clips = s.select("clip").distinct().withColumns({"ei_gender": F.lit(1.0), "global_scores": F.lit(None).cast("string")})
    r = records.score_record(clips, s, b, EVENT_CFG)
    total = F.aggregate("sentences", F.lit(0), lambda t, x: t + F.size(x["bursts"]))
    return r.select("clip", F.size("sentences").cast("bigint").alias("n_sentences"), total.cast("bigint").alias("n_bursts"))


@query("v07_rerender", f"""SELECT conv_id AS clip, turn AS ix, xor(conv_id, (turn + 1) * 2654435761) AS sentence_seed, {T.pick(TEMPLATES, T.draw('xor(conv_id, (turn + 1) * 2654435761)', 'augment-template'))} AS cue,
CASE WHEN role = 'user' THEN rtrim(text, '.') || ' (' || role || ')' ELSE text END AS text FROM conversations""")
def v07_rerender(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("clip"), F.col("turn").alias("ix"), "text", F.col("conv_id").alias("seed"), F.when(F.col("role") == "user", F.array("role")).otherwise(F.array().cast("array<string>")).alias("bursts"))
    c = records.sentence_seeds(c).withColumn("cue", seeded.augment_draws(F.col("sentence_seed"))[0])
    seeds = c.select("clip", "ix", "sentence_seed")
    return records.rerender_lines(c).join(seeds, ["clip", "ix"])


# ---- texts from stored scores ----
def _again(seed: str, k: int = 5, always: tuple = CFG.always_on, gated: bool = True) -> tuple[str, str]:
    """SQL of the form and of the detail that a seed draws."""
    shuffled = f"({T.draw(seed, 'augment-shuffle')} < 2147483648)"
    of = lambda shuffle: T.detail(k, 3, always, gated, f"({T.draw(seed, 'augment-synonym')} % 1073741824)", shuffle)
    return T.pick(TEMPLATES, T.draw(seed, "augment-template")), f"SELECT * FROM ({of(True)} SELECT * FROM detail) WHERE {shuffled} UNION ALL SELECT * FROM ({of(False)} SELECT * FROM detail) WHERE NOT {shuffled}"


def _general_sql() -> str:
    form, detail = _again("entity_id")
    return f"WITH detail AS ({detail}),\n{T.GROUPS},\nh AS (SELECT *, {form} AS template FROM g) SELECT entity_id, template, {T.any_template('template')} AS text FROM h"


def _cues_sql(ix: int) -> str:
    seed = f"xor(entity_id, {(ix + 1) * seeded.SENTENCE_STEP})"
    form, detail = _again(seed, 3, (), False)
    phrases = "string_agg(phrase, '; ' ORDER BY part_ix, pos) AS p, string_agg(nullif(tag, ''), ', ' ORDER BY part_ix, pos) AS t"
    return f"SELECT entity_id AS clip, {ix} AS ix, CASE WHEN {form} = 'tags' THEN coalesce(t, 'unremarkable') ELSE coalesce('Delivered ' || p || '.', 'An even, unremarkable delivery.') END AS cue FROM (SELECT entity_id, {phrases} FROM ({detail}) WHERE part <> 'quality' GROUP BY entity_id)"


_CUES = " UNION ALL ".join(f"({_cues_sql(i)})" for i in range(2))


def _stored(spark, sf):
    """Scores, seeds and expert values of suppliers, and two sentences for each, which have their supplier's scores."""
    s = _scores(spark, sf)
    who = demo.experts(spark, sf).withColumn("seed", F.col("entity_id"))
    said = who.select(F.col("entity_id").alias("clip"), F.explode(F.array(F.lit(0), F.lit(1))).alias("ix"))
    said = said.withColumns({"text": F.concat(F.lit("Line "), F.col("ix").cast("string"), F.lit(".")), "bursts": F.when(F.pmod("clip", F.lit(3)) == F.col("ix"), F.array(F.lit("Sigh"), F.lit("Gasp"))).otherwise(F.array().cast("array<string>"))})
    inner = s.withColumn("ix", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("entity_id", F.struct(F.col("entity_id").alias("clip"), "ix"))
    return s, who, inner, said, stages.once(demo.supplier_baseline(s), "baseline")


@query("v05_augment_global", _general_sql())
def v05_global(spark, sf):
    s, who, _, _, base = _stored(spark, sf)
    return records.augment_global(s, who, base, LEXICON, CFG)


@query("v06_augment_sentence", _CUES)
def v06_sentences(spark, sf):
    _, _, inner, said, base = _stored(spark, sf)
    who = said.select(F.struct("clip", "ix").alias("entity_id"), seeded.sentence_seed(F.col("clip"), F.col("ix")).alias("seed"))
    return records.augment_sentences(inner, who, base, LEXICON, CFG).select("entity_id.clip", "entity_id.ix", "cue")


@query("v07_augment_script", f"WITH c AS ({_CUES}), g AS ({_general_sql()}), l AS (SELECT *, 'Line ' || ix || CASE WHEN clip % 3 = ix THEN ' (Sigh) (Gasp)' ELSE '.' END AS line FROM c) SELECT entity_id AS clip, 'GENERAL: ' || g.text || chr(10) || 'SCRIPT:' || chr(10) || string_agg('(' || cue || ') ' || line, chr(10) ORDER BY ix) AS document FROM g JOIN l ON l.clip = g.entity_id GROUP BY entity_id, g.text")
def v07_script(spark, sf):
    s, who, inner, said, base = _stored(spark, sf)
    return records.augment_script((s, who), inner, said, base, LEXICON, CFG)


# ---- heads ----
_W = [((i * 37) % 11 - 5) / 10 for i in range(64)]
_MU, _SD = [((i * 13) % 7 - 3) / 50 for i in range(64)], [0.5 + (i % 5) / 10 for i in range(64)]
_arr = lambda v: "[" + ", ".join(map(str, v)) + "]::DOUBLE[]"


@query("p17_clamp", "SELECT event_id, CASE WHEN isnan(x) THEN x ELSE greatest(0.0, least(6.0, x)) END AS v FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE value / 5 - 2 END AS x FROM events)")
def p17_clamp(spark, sf):
    x = F.when(F.pmod("event_id", F.lit(7)) == 0, float("nan")).otherwise(F.col("value") / 5 - 2)
    return table(spark, sf, "events").select("event_id", S.clamp(x, 0.0, 6.0).alias("v"))


@query("p18_standardise", f"SELECT vec_id, i::INT AS i, round((embedding[i + 1]::DOUBLE - ({_arr(_MU)})[i + 1]) / ({_arr(_SD)})[i + 1], 5) AS v FROM embeddings, (SELECT unnest(range(64)) AS i)")
def p18_standardise(spark, sf):
    lit = lambda v: F.array(*map(F.lit, v))
    x = infer.standardise(F.col("embedding").cast("array<double>"), lit(_MU), lit(_SD))
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(x).alias("i", "v")).withColumn("v", F.round("v", 5))


@query("p19_linear_head", f"SELECT vec_id, round(greatest(0.0, least(6.0, list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * ({_arr(_W)})[i])) * 4 + 3)), 4) AS v FROM embeddings")
def p19_linear(spark, sf):
    y = infer.dot(F.col("embedding"), F.array(*map(F.lit, _W)))
    return table(spark, sf, "embeddings").select("vec_id", F.round(S.clamp(y * 4 + 3, 0.0, 6.0), 4).alias("v"))


def _net(hidden: int, act: str) -> infer.Net:
    w1 = np.array([[((i * 37 + h * 17) % 11 - 5) / 10 for i in range(64)] for h in range(hidden)])
    w2 = np.array([[((h * 7) % 5 - 2) / 4 for h in range(hidden)]])
    return infer.Net([("linear", w1, np.zeros(hidden)), (act,), ("linear", w2, np.array([3.0]))], np.array(_MU), np.array(_SD), 0.0, 6.0)


def gelu_sql(x: str) -> str:
    """By the nested series of erf, as infer.erf_column has it."""
    y = f"greatest(-6.0, least(6.0, ({x}) / sqrt(2.0::DOUBLE)))"
    nested = f"list_reduce(list_concat([1.0::DOUBLE], list_reverse(list_transform(range(1, {infer.TERMS + 1}), lambda n: n::DOUBLE))), lambda t, n: 1.0 + t * 2.0 * ({y}) * ({y}) / (2 * n + 1))"
    return f"(({x}) * 0.5 * (1.0 + 2.0 / sqrt(pi()) * exp(-({y}) * ({y})) * ({y}) * {nested}))"


def _gelu_sql(hidden: int) -> str:
    a = f"list_sum(list_transform(range(64), lambda i: ((embedding[i + 1]::DOUBLE - ({_arr(_MU)})[i + 1]) / ({_arr(_SD)})[i + 1]) * (((i * 37 + h * 17) % 11 - 5) / 10.0::DOUBLE)))"
    return f"SELECT vec_id, 'gelu{hidden}' AS head, round(greatest(0.0, least(6.0, 3 + sum(((h * 7) % 5 - 2) / 4.0::DOUBLE * {gelu_sql('a')}))), 4) AS value FROM (SELECT vec_id, h, {a} AS a FROM embeddings, (SELECT unnest(range({hidden})) AS h)) GROUP BY vec_id"


@query("p19_gelu_head", f"{_gelu_sql(8)} UNION ALL {_gelu_sql(16)}")
def p19_gelu(spark, sf):
    return infer.run_heads(table(spark, sf, "embeddings"), "vec_id", "embedding", {"gelu8": _net(8, "gelu"), "gelu16": _net(16, "gelu")}).withColumn("value", F.round("value", 4))


_RELU = "list_sum(list_transform(range(4), lambda h: (((h * 7) % 5 - 2) / 4.0::DOUBLE) * greatest(0.0, list_sum(list_transform(range(64), lambda i: ((embedding[i + 1]::DOUBLE - ({mu})[i + 1]) / ({sd})[i + 1]) * (((i * 37 + h * 17) % 11 - 5) / 10.0::DOUBLE))))))".format(mu=_arr(_MU), sd=_arr(_SD))


@query("p21_relu_head", f"SELECT vec_id, 'relu4' AS head, round(greatest(0.0, least(6.0, {_RELU} + 3)), 4) AS value FROM embeddings")
def p21_relu(spark, sf):
    return infer.run_heads(table(spark, sf, "embeddings"), "vec_id", "embedding", {"relu4": _net(4, "relu")}).withColumn("value", F.round("value", 4))


@query("p26_head_file", "SELECT DISTINCT role, 'model_' || role || '_best.pth' AS file FROM conversations UNION ALL SELECT 'Hope/Optimism', 'model_Hope_Enthusiasm_Optimism_best.pth' UNION ALL SELECT 'Jealousy & Envy', 'model_Jealousy_&_Envy_best.pth'")
def p26_files(spark, sf):
    names = table(spark, sf, "conversations").select("role").distinct().unionByName(spark.createDataFrame([("Hope/Optimism",), ("Jealousy & Envy",)], "role string"))
    return names.select("role", infer.head_file(F.col("role")).alias("file"))


# ---- evaluation ----
@query("a10_mae_sign", "SELECT count(*) AS n, round(avg(abs(quality - toxic)), 4) AS mae, count(*) FILTER (WHERE sign(quality) = sign(toxic)) AS sign_agree FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def a10_mae(spark, sf):
    return evaluate.agreement(table(spark, sf, "labels"), F.col("quality"), F.col("toxic"))


@query("a10_share", "SELECT lang, count(*) AS n, count(*) FILTER (WHERE toxic > 0) AS hits FROM labels JOIN documents USING (doc_id) GROUP BY lang")
def a10_share(spark, sf):
    return evaluate.share(table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id"), F.col("toxic") > 0, "lang")


@query("a10_votes", "SELECT role AS choice, count(*) AS n FROM conversations GROUP BY role")
def a10_votes(spark, sf):
    return evaluate.votes(table(spark, sf, "conversations"), "role")


@query("j04_index_embeddings", "SELECT l.doc_id, e.label FROM labels l JOIN embeddings e ON e.vec_id = l.doc_id WHERE l.quality = 1")
def j04_index(spark, sf):
    ix = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    return ix.join(table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label"), "doc_id")


@query("j06_label_group", f"WITH {_TAX_SQL} SELECT vec_id, class AS label, grp FROM embeddings LEFT JOIN tax ON class_ix = label * 7")
def j06_group(spark, sf):
    tax = spark.createDataFrame(_TAX[:-1], "class_ix int, label string, grp string")
    return table(spark, sf, "embeddings").select("vec_id", (F.col("label") * 7).alias("class_ix")).join(F.broadcast(tax), "class_ix", "left").drop("class_ix")


@query("s05_multi_file", "SELECT count(*) AS n, sum(l_quantity) AS quantity FROM lineitem")
def s05_scan(spark, sf):
    from ..sources.scans import parquet_files

    return parquet_files(spark, sf, "lineitem*.parquet", ["l_quantity"]).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("ext_stream_score", None)
def ext_stream(spark, sf):
    """Streamed events against the batch baseline; the stream is drained and its rows are returned."""
    import uuid

    from ..streaming.live import score_stream

    base = stats.baseline_stats(table(spark, sf, "events").select(F.col("event_type").alias("dim"), "value"))
    raw = table(spark, sf, "events")
    live = spark.readStream.schema(raw.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf}/events.parquet*")
    root = f"{stages.shared_dir(spark)}/live-{uuid.uuid4().hex[:12]}"
    scored = score_stream(live.select("event_id", F.col("event_type").alias("dim"), "value"), base)
    scored.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(scored.schema).parquet(f"{root}/out").select("event_id", "dim", F.round("z", 2).alias("z"), "intensity")


@query("ext_stream_islands", f'WITH {T.FRAMES}, {T.ISLANDS} SELECT clip, start, "end", n_frames, peak FROM spans')
def ext_stream_islands(spark, sf):
    """Frames that arrive file by file, the parts of each clip in several files; a last file with a later frame moves the watermark on."""
    import uuid

    from ..streaming.live import live_islands

    root = f"{stages.shared_dir(spark)}/live-{uuid.uuid4().hex[:12]}"
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("frame_ix").cast("long"))
    frames = demo.event_frames(spark, sf).select("clip", "frame_ix", "p", at.alias("time"))
    frames.repartitionByRange(6, "frame_ix").sortWithinPartitions("frame_ix").write.parquet(f"{root}/in/a")
    # files may come in any order, so a frame may be as late as the longest clip is long; one frame of a clip of its own, far later, closes
    # what is open and stays open itself
    n = (frames.agg(F.max("frame_ix")).first()[0] or 0) + 1
    last = spark.range(1).select((F.lit(3 * n + 10)).alias("frame_ix")).select(F.lit(-1).cast(dict(frames.dtypes)["clip"]).alias("clip"), F.col("frame_ix").cast("int").alias("frame_ix"), F.lit(1e9).alias("p"), at.alias("time"))
    last.write.parquet(f"{root}/in/b")
    live = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in/*")
    found = live_islands(live, EVENT_CFG, "time", f"{n} seconds")
    found.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{root}/out")


from . import flows, trips  # noqa: E402, F401  registers more
