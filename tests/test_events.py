from pyspark.sql import functions as F

from outlyne.model import Config
from outlyne.operators import evaluate, infer, placement, spans

CFG = Config()
W, SN, B = "clip long, ix int, w string, start double, end double", "clip long, ix int, text string, start double, end double", "clip long, b_ix long, start double, end double, label string"


def test_islands_edges(spark):
    p = [0.8, 0.8, 0.1, 0.75, 0.9, 0.8, 0.1, 0.9, 0.9, 0.9]
    f = spark.createDataFrame([(1, i, x) for i, x in enumerate(p)] + [(2, 0, None), (2, 1, float("nan"))], "clip long, frame_ix int, p double")
    got = [(r["start"], r["end"], r["n_frames"], r["peak"]) for r in spans.islands(f, CFG).orderBy("start").collect()]
    assert got == [(0.06, 0.12, 3, 0.9), (0.14, 0.2, 3, 0.9)]
    cut = spark.createDataFrame([(1, 0.15)], "clip long, dur double")
    assert [r["start"] for r in spans.islands(f, CFG, cut).collect()] == [0.06]


def test_classes_and_durations(spark):
    tax = spark.createDataFrame([(0, "Click", "tongue_clicks"), (1, "Laugh", "laughter"), (2, "no_burst", None)], "class_ix int, class string, grp string")
    rows = [(1, [0.9, 0.9, 0.1], 0.0, 0.6), (2, [0.9, 0.1, 0.1], 0.0, 0.59), (3, [0.1, 0.9, 0.1], 0.0, 0.3), (4, [0.1, 0.9, 0.5], 0.0, 9.0), (5, [0.1, 0.9, 0.1], 0.0, 0.05)]
    s = spark.createDataFrame(rows, "id long, scores array<double>, start double, end double").withColumn("peak", F.lit(0.12345))
    got = {r["id"]: r for r in spans.duration_gate(spans.classify(s, tax, CFG, F.col("end") - F.col("start")), CFG).collect()}
    assert [got[i]["label"] for i in range(1, 6)] == ["Click", "Click", "Laugh", None, None]
    assert [got[i]["kept"] for i in range(1, 6)] == [True, False, True, False, False]
    assert (got[4]["prob"], got[5]["prob"], got[5]["p_noburst"]) == (0.5, 0.0, 1.0) and got[2]["dur_gated"] and got[1]["peak"] == 0.123
    assert evaluate.span_counts(spans.duration_gate(spans.classify(s, tax, CFG), CFG)).first()["n_no_burst"] == 1


def test_inside_beats_nearest_and_edges(spark):
    s = spark.createDataFrame([(1, 0, "a.", 0.0, 1.0), (1, 1, "b.", 2.0, 3.0), (1, 2, "c.", 1.1, 5.0), (1, 3, "d.", None, None), (2, 0, "x.", None, None)], SN)
    b = spark.createDataFrame([(1, 1, 1.2, 1.2, "edge"), (1, 2, 2.5, 2.5, "two"), (1, 3, 9.0, 9.0, "far"), (2, 4, 1.0, 1.0, "none"), (3, 5, 1.0, 1.0, "lost")], B)
    got = {r["label"]: r["s_ix"] for r in placement.bursts_to_sentences(b, s, CFG).collect()}
    assert got == {"edge": 0, "two": 1, "far": 2, "none": 0, "lost": 0}
    over = {(r["clip"], r["ix"]): r["bursts"] for r in placement.overlapping(b, s, CFG).collect()}
    assert over[1, 0] == ["edge"] and over[1, 1] == ["two"] and over[1, 2] == ["edge", "two"] and over[1, 3] == []


def test_inline_pauses_and_bursts(spark):
    w = spark.createDataFrame([(1, 0, "one", 0.0, 0.5), (1, 1, "two", 0.8, 1.0), (1, 2, "three", 2.0, 2.5), (1, 3, "untimed", None, None), (1, 4, "four", 2.6, None), (1, 5, "five", 3.0, 3.1)], W)
    b = spark.createDataFrame([(1, 1, 1.2, 1.4, "L"), (1, 2, 9.0, 9.2, "E"), (2, 3, 1.0, 1.1, "B2"), (2, 4, 0.5, 0.6, "B1")], B)
    got = {r["clip"]: r["text"] for r in placement.inline(w, b, CFG, ["clip"]).collect()}
    assert got == {1: "one [pause 0.3s] two (L) three four [pause 0.4s] five (E)", 2: "(B1) (B2)"}
    assert "[pause" not in placement.inline(w, b, Config(pause=0.0), ["clip"]).filter("clip = 1").first()["text"]


def test_slots_never_go_back(spark):
    w = placement.numbered(spark.createDataFrame([(1, 0, "a", 1.0, 1.1), (1, 1, "b", 5.0, 5.1)], W), ["clip"])
    b = spark.createDataFrame([(1, 1, 0.0, 8.0, "long"), (1, 2, 0.5, 0.6, "short")], B)
    assert {r["label"]: r["slot"] for r in placement.slots(w, b, ["clip"]).collect()} == {"long": 1, "short": 1}


def test_script_lines(spark):
    s = spark.createDataFrame([(1, 0, "Hello there.", 0.0, 1.0), (1, 1, "No words..", 3.0, 4.0), (1, 2, "Last", None, None)], SN)
    w = spark.createDataFrame([(1, 0, "Hello", 0.0, 0.4), (1, 1, "there.", 0.5, 1.0)], W)
    b = spark.createDataFrame([(1, 1, 0.4, 0.6, "Sigh"), (1, 2, 3.2, 3.6, "Cough"), (9, 3, 0.0, 1.0, "Alone")], B)
    got = {(r["clip"], r["ix"]): r["text"] for r in placement.script_lines(w, s, b, CFG).collect()}
    assert got == {(1, 0): "Hello (Sigh) there.", (1, 1): "[pause 2.0s] No words (Cough)", (1, 2): "Last", (9, 0): "(Alone)"}
    general = spark.createDataFrame([(1, "G")], "clip long, text string")
    doc = placement.document(general, placement.script_lines(w, s, b, CFG).withColumn("cue", F.lit("c"))).first()["document"]
    assert doc.split("\n") == ["GENERAL: G", "SCRIPT:", "(c) Hello (Sigh) there.", "(c) [pause 2.0s] No words (Cough)", "(c) Last"]


def test_heads(spark):
    import numpy as np

    net = infer.Net([("linear", np.eye(2), np.zeros(2)), ("gelu",), ("linear", np.ones((1, 2)), np.zeros(1))], lo=0.0, hi=6.0)
    df = spark.createDataFrame([(1, [1.0, -1.0]), (2, None), (3, [100.0, 0.0])], "id long, v array<double>")
    got = {r["id"]: r["value"] for r in infer.run_heads(df, "id", "v", {"h": net}).collect()}
    assert abs(got[1] - 0.6826894921) < 1e-9 and got[2] is None and got[3] == 6.0
    conv = infer.Net([("conv", np.ones((1, 1, 3)), np.zeros(1)), ("relu",), ("norm", np.ones(1), np.zeros(1)), ("sigmoid",)])
    assert conv(np.ones((1, 4, 1))).shape == (1, 4, 1)
    assert [r[1] for r in infer.run_classifier(df, "id", "v", infer.Net([("linear", np.eye(2), np.zeros(2))])).orderBy("id").collect()] == [[1.0, -1.0], None, [100.0, 0.0]]


def test_agreement(spark):
    rows = spark.createDataFrame([(2, 1), (-1, -1), (0, 1), (None, 1), (1, -2)], "a int, b int")
    r = evaluate.agreement(rows, F.col("a"), F.col("b")).first()
    assert (r["n"], r["mae"], r["sign_agree"]) == (4, 1.25, 2)


def test_one_long_clip(spark):
    """50,000 words, 10,000 sentences and as many bursts in one clip, against numpy."""
    import numpy as np

    from outlyne.model import Config
    from outlyne.operators import placement

    rnd, cfg = np.random.default_rng(3), Config()
    words = spark.range(50_000).selectExpr("'c' AS clip", "CAST(id AS INT) AS ix", "concat('w', id) AS w", "id * 0.5D AS start", "id * 0.5D + 0.4D AS end")
    sent = spark.range(10_000).selectExpr("'c' AS clip", "CAST(id AS INT) AS ix", "'t' AS text", "id * 2.5D AS start", "id * 2.5D + 1.9D AS end")
    mid = np.sort(rnd.integers(-40, 250_400, 10_000)) / 10 + 0.05
    bursts = spark.createDataFrame([("c", i, float(m) - 0.25, float(m) + 0.25, "B") for i, m in enumerate(mid)], "clip string, b_ix long, start double, end double, label string")
    mid = np.array([((m - 0.25) + (m + 0.25)) / 2 for m in mid])
    placed = {r["b_ix"]: r["s_ix"] for r in placement.bursts_to_sentences(bursts, sent, cfg).collect()}
    a = np.arange(10_000) * 2.5
    b = a + 1.9
    for i in rnd.integers(0, 10_000, 300).tolist():
        m = mid[i]
        inside = np.flatnonzero((a - cfg.slack <= m) & (m <= b + cfg.slack))
        assert placed[i] == (inside[0] if len(inside) else int(np.argmin(np.minimum(np.abs(m - a), np.abs(m - b)))))
    got = {r["b_ix"]: r["slot"] for r in placement.slots(placement.numbered(words, ["clip"]), bursts, ["clip"]).collect()}
    want = np.maximum.accumulate(np.searchsorted(np.arange(50_000) * 0.5, mid))
    assert len(placed) == len(got) == 10_000 and [got[i] for i in range(10_000)] == want.tolist()
    assert placement.words_in_sentences(words, sent).count() == 40_000
    hit = placement.overlapping(bursts, sent, cfg).selectExpr("sum(size(bursts))").first()[0]
    assert hit == sum(((a - cfg.slack <= m) & (m <= b + cfg.slack)).sum() for m in mid)
