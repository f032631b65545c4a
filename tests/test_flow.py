"""The one-call flow on clips made by hand."""

import re
from dataclasses import replace

from pyspark.sql import functions as F

from outlyne.model import NOTHING, Config, Lexicon
from outlyne.operators import flow

CFG = replace(Config(), frames_per_second=10, min_frames=2, locator_threshold=0.5)
TAX = [(0, "Laugh", "laughter"), (1, "Smack", "mouth_and_lip_sounds"), (2, "no_burst", None)]
BASE = "grp string, dim string, name string, median double, mad double, std double, spread double, synonyms array<string>"


def _given(spark, clips, frames, words, sentences, scores=(), inner=()):
    row = "grp string, dim string, dim_ix int, value double"
    return flow.Clips(
        spark.createDataFrame(clips, "clip string, dur double, expert double, error string"),
        spark.createDataFrame([(c, i, p) for c, ps in frames.items() for i, p in ps], "clip string, frame_ix int, p double"),
        spark.createDataFrame(words, "clip string, ix int, w string, start double, end double"),
        spark.createDataFrame(sentences, "clip string, ix int, text string, start double, end double"),
        spark.createDataFrame(list(scores), f"entity_id string, {row}"),
        spark.createDataFrame(list(inner), f"entity_id struct<clip:string,ix:int>, {row}"),
    )


def _run(spark, given, classes):
    """classes: start of a segment -> probabilities; others are no burst."""
    said = F.lit(None).cast("array<double>")
    for t, p in classes.items():
        said = F.when(F.abs(F.col("start") - t) < 1e-9, F.array(*map(F.lit, p))).otherwise(said)
    classifier = lambda seg: seg.withColumn("scores", F.coalesce(said, F.array(F.lit(0.1), F.lit(0.1), F.lit(0.9))))
    base = spark.createDataFrame([("trait", "WARM", "Warmth", 0.0, 1 / 1.4826, 1.0, 1.0, None), ("trait", "GEND", "Gender", 0.0, 1 / 1.4826, 1.0, 1.0, None)], BASE)
    words = Lexicon(dims={"WARM": ("warm", "cold", "warm", "cold")})
    out = flow.captions(given, base, classifier, spark.createDataFrame(TAX, "class_ix int, class string, grp string"), words, CFG)
    return {r["clip"]: r for r in out.collect()}


def test_flow(spark):
    hot = lambda a, b: [(i, 0.9) for i in range(a, b)]
    given = _given(
        spark,
        [("a", 5.0, 0.1, None), ("bad", 1.0, None, "not audio"), ("empty", 1.0, -0.9, None)],
        # kept; too short for its group; one frame only; no burst; beyond the clip's end
        {"a": hot(10, 15) + hot(20, 24) + hot(27, 28) + hot(30, 35) + hot(60, 70), "bad": hot(0, 9), "gone": hot(0, 9)},
        [("a", 0, "Oh", 0.0, 0.4), ("a", 1, "well", 0.5, 0.9), ("a", 2, "then", 1.6, 2.0), ("a", 3, "yes", 3.9, 4.2), ("bad", 0, "x", 0.0, 0.1)],
        [("a", 0, "Oh well then.", 0.0, 2.0), ("a", 1, "yes.", 3.9, 4.2), ("bad", 0, "x.", 0.0, 0.1)],
        [("a", "trait", "WARM", 0, 2.5), ("a", "trait", "GEND", 1, 1.0)],
        [(("a", 0), "trait", "WARM", 0, -1.2)],
    )
    got = _run(spark, given, {1.0: (0.8, 0.1, 0.1), 2.0: (0.1, 0.7, 0.1), 3.8: (0.6, 0.2, 0.2)})
    a = got["a"]
    assert a["global_caption"] == "A voice that is extremely warm." and a["gated"]  # a weak expert value takes the gated dimension out
    assert a["document"] == "GENERAL: A voice that is extremely warm.\nSCRIPT:\n(Delivered notably cold.) Oh well (Laugh) then\n(An even, unremarkable delivery.) [pause 1.9s] yes."
    assert a["inline"] == "Oh well (Laugh) then [pause 1.9s] yes"
    assert [(b["start"], b["end"], b["label"], b["kept"], b["dur_gated"]) for b in a["bursts"]] == [(1.0, 1.5, "Laugh", True, False), (2.0, 2.4, "Smack", False, True), (3.0, 3.5, None, False, False)]
    assert [b["dur_floor"] for b in a["bursts"]] == [0.3, 0.6, 0.0]
    assert a["n_spans"] == 3 and a["n_words"] == 4
    # each sentence is also classified whole, padded
    assert [s["burst"] for s in a["sentences"]] == [None, "Laugh"]
    assert a["sentences"][0]["burst_caption"] == "Delivered notably cold." and a["sentences"][1]["burst_caption"].startswith("An even, unremarkable delivery, ")
    assert "(Laugh)" in a["sentences"][1]["burst_caption"]
    bad = got["bad"].asDict()
    assert (bad.pop("clip"), bad.pop("error")) == ("bad", "not audio") and set(bad.values()) == {None}
    e = got["empty"]
    assert e["document"] == f"GENERAL: {NOTHING}\nSCRIPT:" and (e["inline"], e["n_spans"], e["n_words"], e["sentences"], e["bursts"]) == ("", 0, 0, [], [])
    assert set(got) == {"a", "bad", "empty"}


def test_flow_of_nothing(spark):
    assert _run(spark, _given(spark, [], {}, [], []), {}) == {}


def test_flow_without_sentences_or_finite_frames(spark):
    frames = {"m": [(0, None), (1, float("nan")), (2, 0.9), (3, 0.9), (4, 0.9), (5, float("inf"))]}
    got = _run(spark, _given(spark, [("m", 0.6, None, None)], frames, [], []), {0.2: (0.9, 0.0, 0.0)})["m"]
    assert got["inline"] == "(Laugh)" and got["document"] == f"GENERAL: {NOTHING}\nSCRIPT:\n() (Laugh)" and not got["gated"]


def _explained(spark, df, mode):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_descriptions_are_compiled_and_sorted_once(spark):
    """The JVM interprets methods beyond 8000 bytes; the gate and the ranks share one order."""
    from outlyne.plans.demo import LEXICON

    base = spark.createDataFrame([("trait", "QTY", "Quantity", 0.0, 1.0, 1.0, 1.0, ["many", "lots"])], BASE)
    scores = spark.createDataFrame([(("a", 0), "trait", "QTY", 0, 2.5)], "entity_id struct<clip:string,ix:int>, grp string, dim string, dim_ix int, value double")
    clips = spark.createDataFrame([("a", 1.0)], "entity_id string, expert double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        inner = flow.select.detail(scores, base, LEXICON, replace(CFG, k_dims=3, always_on=()), flow.seeded.sentence_seed(flow.seeded.clip_seed(F.col("entity_id.clip")), F.col("entity_id.ix")))
        whole = flow.select.detail(scores.withColumn("entity_id", F.col("entity_id.clip")), base, LEXICON, CFG, flow.seeded.clip_seed(F.col("entity_id")), clips)
        for d in (inner, whole):
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", _explained(spark, d, "codegen"))]
            assert sizes and max(sizes) <= 8000, sizes
            assert len(re.findall(r"Sort \[[^\n]*grp", _explained(spark, d, "simple"))) == 1
        assert [r["phrase"] for r in inner.collect()] == ["extremely large in order quantity"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_inline_and_runs_read_their_scans_once(spark):
    from outlyne.operators import placement, series

    words = spark.createDataFrame([("a", 0, "x", 0.0, 0.1), ("a", 1, None, 5.0, 5.1), ("a", 2, "z", 9.0, None), ("a", 3, "no", None, None), ("a", 4, "end", 19.0, 19.5)], "clip string, ix int, w string, start double, end double")
    bursts = spark.createDataFrame([("a", 0, 7.0, 8.0, "B"), ("b", 0, 1.0, 2.0, "C"), ("a", 1, 30.0, 31.0, "D")], "clip string, b_ix long, start double, end double, label string")
    text = placement.inline(words, bursts, CFG, ["clip"])
    assert _explained(spark, text, "simple").count("Window [") <= 4  # of two running values of the bursts, in their pieces and over them
    assert {r["clip"]: r["text"] for r in text.collect()} == {"a": "x [pause 4.9s] (B) z [pause 10.0s] end (D)", "b": "(C)"}
    none = placement.inline(words, bursts, replace(CFG, pause=0.0), ["clip"])
    assert {r["clip"]: r["text"] for r in none.collect()} == {"a": "x (B) z end (D)", "b": "(C)"}
    marked = spark.createDataFrame([("a", i) for i in (0, 1, 2, 5, 7, 8, 9, 10)], "clip string, i long")
    found = series.runs(marked.withColumnRenamed("i", "at"), ["clip"], "at", {}, rows=4)
    assert _explained(spark, found, "simple").count("row_number") == 0
    assert sorted((r["i"], r["j"], r["n"]) for r in found.collect()) == [(0, 2, 3), (5, 5, 1), (7, 10, 4)]
