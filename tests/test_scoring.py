import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outlyne.functions import scoring as S
from outlyne.plans.demo import LEXICON
from outlyne.model import BANDS, Config, Lexicon
from outlyne.operators import render, seeded, select, stats


def col(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_tiers(spark):
    z = [0.4999, 0.5, 1.0, 1.5, 2.0, -0.5, -2.0]
    assert col(spark, z, S.tier) == ["Somewhat", "Somewhat", "Notably", "Very", "Extremely", "Somewhat", "Extremely"]
    assert col(spark, z, lambda c: S.tier(c, F.lit(True))) == ["Somewhat", "Somewhat", "Notably", "Notably", "Notably", "Somewhat", "Notably"]


def test_bands(spark):
    b = BANDS["GEND"]
    got = col(spark, [1.4999, 1.5, 2.5, 3.5, 4.5, 98.9, 99.0, math.nan, None], lambda c: S.level(c, *zip(*b)))
    assert got == [b[0][1], b[1][1], b[2][1], b[3][1], b[4][1], b[4][1], None, None, None]


def test_spread(spark):
    rows = [(None, 1.0, 1.0), (5.0, 1.0, 1.0), (0.0, 0.1, 1.0), (None, 0.0, 0.0), (None, None, None), (1e-7, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "s double, m double, d double")
    got = [r[0] for r in df.select(S.spread(F.col("s"), F.col("m"), F.col("d"))).collect()]
    assert got == pytest.approx([1.4826, 5.0, 1.0, 1.0, 1.0, 2.9652])


def test_genuineness_edges(spark):
    df = spark.createDataFrame([(2.0, 2.0, 0.0), (1.9, 2.0, -0.1), (1.0, 2.0, -1.0), (None, 2.0, None), (1.0, None, None)], "v double, m double, z double")
    assert [r[0] for r in df.select(S.gate(F.col("v"), F.col("m"), F.col("z"))).collect()] == ["open", "capped", "dropped", "open", "open"]
    assert col(spark, [0.5, 0.0, -0.99, -1.0, None], S.genuine_tag) == ["genuine", "genuine", "semi-genuine", "performed", None]


def test_clamp_sigmoid_pause(spark):
    got = col(spark, [-1.0, 3.0, 7.0, math.nan], lambda c: S.clamp(c, 0.0, 6.0))
    assert got[:3] == [0.0, 3.0, 6.0] and math.isnan(got[3])
    assert col(spark, [0.0], S.sigmoid) == [0.5]
    assert col(spark, [0.25, 0.35, 2.04, 10.0], S.pause_text) == ["[pause 0.3s]", "[pause 0.4s]", "[pause 2.0s]", "[pause 10.0s]"]


def test_cells(spark):
    cells = ["1.5", '"2.5"', '{"value": 3}', '{"r": 4, "score": 9}', '{"x": 1}', "abc", None, '{"value": null, "r": 2}']
    assert col(spark, cells, S.scalar_cell, "string") == [1.5, 2.5, 3.0, 4.0, None, None, None, None]


def test_text_helpers(spark):
    assert col(spark, ["a(b)<c>", "", None], lambda c: S.emphasise(S.html_escape(c)), "string") == ['a<span class="burst">(b)</span>&lt;c&gt;', "", None]
    assert col(spark, [" éa b", "", None], S.first_upper, "string") == ["Éa b", "", None]


def test_stats_edges(spark):
    rows = [("a", v) for v in (1.0, 2.0, 3.0, 100.0, math.nan, math.inf, None)] + [("flat", 2.0)] * 3 + [("zeros", v) for v in [0.0] * 9 + [10.0]] + [("none", None)]
    got = {r["dim"]: r for r in stats.baseline_stats(spark.createDataFrame(rows, "dim string, value double")).collect()}
    assert set(got) == {"a", "flat", "zeros"}
    assert got["a"]["n"] == 4 and got["a"]["median"] == 2.5 and got["a"]["p10"] == 1.3 and got["a"]["mad"] == 1.0
    assert got["flat"]["spread"] == 1.0 and got["zeros"]["mad"] == 0.0 and got["zeros"]["spread"] == got["zeros"]["std"] == 3.0
    assert stats.baseline_stats(spark.createDataFrame([], "dim string, value double")).count() == 0


def test_distributed_quantiles(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    groups = {"one": [5.0], "two": [1.0, 2.0], "ties": [3.0] * 900 + [9.0] * 100, "many": rnd.normal(size=999).tolist(), "neg": [-1.0, 0.0, 7.5, 7.5]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "dim string, value double")
    got = {r["dim"]: r["q"] for r in stats.exact_quantiles(df, ["dim"], (0.5, 0.1, 0.9, 0.0, 1.0)).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(np.percentile(vs, [50, 10, 90, 0, 100]).tolist()), g
    a, b = (sorted(map(tuple, stats.baseline_stats(df, distributed=d).collect())) for d in (False, True))
    assert a == b


def _z(spark, rows):
    return spark.createDataFrame(rows, "entity_id long, dim string, dim_ix int, value double, z double")


def test_top_k_and_always_on(spark):
    rows = [(1, "A", 0, 1.0, 1.0), (1, "B", 1, 1.0, -1.0), (1, "C", 2, 1.0, 0.2), (1, "TEMP", 3, 1.0, 0.1), (1, "REGS", 4, 1.0, 3.0)]
    top = lambda k: [r["dim"] for r in select.top_k(_z(spark, rows), k).orderBy("rk").collect()]
    assert top(3) == ["REGS", "A", "B"] and top(0) == [] and top(-1) == []
    got = select.with_always_on(_z(spark, rows), 2, ("AGEV", "GEND", "REGS", "TEMP")).orderBy("pos").collect()
    assert [(r["dim"], r["always_on"]) for r in got] == [("REGS", True), ("A", False), ("TEMP", True)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-3, 3), min_size=1, max_size=8), st.integers(0, 9), st.randoms())
def test_order_does_not_matter(spark, zs, k, rnd):
    rows = [(1, f"D{i}", i, 0.0, z) for i, z in enumerate(zs)]
    mixed = rnd.sample(rows, len(rows))
    pick = lambda r: [x["dim"] for x in select.top_k(_z(spark, r), k).orderBy("rk").collect()]
    assert pick(rows) == pick(mixed) == [r[1] for r in sorted(rows, key=lambda r: (-abs(r[4]), r[2]))][:k]


def test_confidence_gate(spark):
    z = _z(spark, [(i, d, 0, 1.0, 1.0) for i in range(5) for d in ("GEND", "A")])
    ex = spark.createDataFrame([(0, 0.49), (1, 0.5), (2, -0.5), (3, None)], "entity_id long, expert double")
    left = {r[0] for r in select.confidence_gate(z, ex, Config()).filter("dim = 'GEND'").select("entity_id").collect()}
    assert left == {1, 2, 3, 4}
    assert select.confidence_gate(z, ex, Config(confidence_gate=0.0)).count() == 10


def test_forms_hold_every_phrase(spark):
    rows = [(1, 1, "dims", 1, "AGEV", True, "old", "t1"), (1, 1, "dims", 2, "A", False, "loud", "t2"), (1, 2, "emotions", 1, "JOY", False, "carrying joy", ""), (1, 3, "quality", 1, "genuineness", False, "genuine", None)]
    d = spark.createDataFrame(rows, "entity_id long, part_ix int, part string, pos int, dim string, always_on boolean, phrase string, tag string")
    for t in ("default", "identity_first", "emotion_first", "telegraphic", "two_sentence", "sounds_like", "bulleted", "varied_connectors", "quality_led", "minimal_identity", "unknown"):
        text = render.render(d, t).first()["text"].lower()
        assert all(p in text for p in ("old", "loud", "carrying joy", "genuine")), (t, text)
    assert render.render(d, "tags").first()["text"] == "t1, t2"
    assert render.render(d, "varied_connectors").first()["text"] == "A voice that is old, with loud and carrying joy, carrying genuine."
    ids = spark.createDataFrame([(1,), (2,)], "entity_id long")
    assert {r["entity_id"]: r["text"] for r in render.render(d, "default", ids).collect()}[2] == "An average, unremarkable voice."
    assert {r["entity_id"]: r["cue"] for r in render.sentence_cue(d, "default", ids).collect()} == {1: "Delivered old; loud; carrying joy.", 2: "An even, unremarkable delivery."}


def test_shuffle_keeps_rows_and_fixed_places(spark):
    rows = [(e, f"D{i}", i, 0.0, 1.0) for e in range(20) for i in range(6)]
    d = _z(spark, rows).withColumn("pos", F.col("dim_ix") + 1).withColumn("always_on", F.col("dim_ix") == 2)
    got = select.shuffle_positions(d, F.col("entity_id"), "dims", ~F.col("always_on")).collect()
    assert sorted((r["entity_id"], r["dim"]) for r in got) == sorted((r[0], r[1]) for r in rows)
    assert all(r["pos"] == 3 for r in got if r["dim"] == "D2") and len({r["pos"] for r in got if r["dim"] == "D0"}) > 1


def test_samples(spark):
    df = spark.createDataFrame([(f"l{i % 3}", f"s{i % 5}", i) for i in range(90)], "lang string, shard string, id long")
    assert seeded.simple_sample(df, "id", 7).count() == 7 and seeded.simple_sample(df, "id", 700).count() == 90
    a = {r["id"] for r in seeded.stratified_sample(df.repartition(7), "lang", "id", 4).collect()}
    assert a == {r["id"] for r in seeded.stratified_sample(df.coalesce(1), "lang", "id", 4).collect()} and len(a) == 12
    assert seeded.two_level_sample(df, "lang", "shard", "id", 2, 3).count() == 18
    assert seeded.first_shard_sample(df, "shard", "id", 18).select("shard").distinct().count() == 1
    assert seeded.epochs(df.select(F.col("id").alias("example_id")).limit(2), 3).count() == 6


def test_lexicon_defaults():
    assert Lexicon().bands is BANDS and all(len(b) == 5 for b in BANDS.values())


def test_layout(spark):
    recs = [(1, '{"dims": {"A": 1, "genuineness": 2}, "emo": {"Joy": 3}, "blend": 4}'), (2, '{"A": {"score": 5}, "Joy": 6, "genu": 7}'), (3, '{"dims": {"genuineness": 2}, "genu": 1}'), (4, "not json"), (5, None)]
    base = spark.createDataFrame([("emotion", "Joy")], "grp string, dim string")
    got = select.normalise_layout(spark.createDataFrame(recs, "entity_id long, preds string"), base)
    rows = sorted((r["entity_id"], r["grp"], r["dim"], r["v"]) for r in got.select("entity_id", "grp", "dim", S.scalar_cell(F.col("cell")).alias("v")).collect())
    assert rows == [(1, "blend", "blend", 4.0), (1, "dims", "A", 1.0), (1, "emo", "Joy", 3.0), (1, "genu", "genuineness", 2.0), (2, "dims", "A", 5.0), (2, "emo", "Joy", 6.0), (2, "genu", "genu", 7.0), (3, "dims", "genuineness", 2.0), (3, "genu", "genu", 1.0)]


def test_plain_baseline_is_enough(spark):
    """The README's example: a baseline of traits only, without names or synonyms."""
    from outlyne.plans import demo

    from .twins import SF

    scores = demo.supplier_scores(spark, SF)
    baseline = stats.document(stats.baseline_stats(scores.filter("grp = 'trait'")), {}, "trait")
    detail = select.detail(scores, baseline, Lexicon(dims=demo.LEXICON.dims), Config())
    assert {r["part"] for r in detail.select("part").distinct().collect()} == {"dims"}
    assert render.render(detail, "identity_first").count() == 10


def test_values_that_are_no_numbers_pass_no_threshold(spark):
    cells = [(e, "trait", "QTY", 0, v) for e, v in enumerate((float("nan"), float("inf"), float("-inf"), None, 9.0))] + [(0, "trait", "PRICE", 1, 3.5), (0, "quality", "genuineness", 0, float("nan")), (0, "emotion", "OPEN", 0, 4.0)]
    scores = spark.createDataFrame(cells, "entity_id long, grp string, dim string, dim_ix int, value double")
    base = spark.createDataFrame([(g, d, 1.0, 1.0, 1.0, 1.0) for g, d in (("trait", "QTY"), ("trait", "PRICE"), ("quality", "genuineness"), ("emotion", "OPEN"))], "grp string, dim string, median double, std double, mad double, spread double")
    got = select.detail(scores, base, Lexicon(dims=LEXICON.dims), Config(k_dims=1, always_on=())).collect()
    assert {(r["entity_id"], r["part"], r["dim"], r["intensity"]) for r in got} == {(0, "dims", "PRICE", "Extremely"), (0, "emotions", "OPEN", "Extremely"), (4, "dims", "QTY", "Extremely")}


def test_detail_meets_scores_once(spark):
    scores = spark.createDataFrame([(1, "trait", "QTY", 0, 2.0)], "entity_id long, grp string, dim string, dim_ix int, value double")
    base = spark.createDataFrame([("trait", "QTY", 1.0, 1.0, 1.0, 1.0)], "grp string, dim string, median double, std double, mad double, spread double")
    plan = select.detail(scores, base, Lexicon(dims=LEXICON.dims), Config(), shuffle=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Union" not in plan
