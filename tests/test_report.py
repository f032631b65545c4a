"""The page about clips, and the command line."""

import io
import json

from pyspark.sql import functions as F

from outlyne import __main__ as cli
from outlyne.operators import stats
from outlyne.sources import report, scans

CLIP = "clip string, error string, dur double, n_words long, n_spans int, global_caption string, inline string, sentences array<struct<text:string,caption:string,burst:string,burst_caption:string>>, bursts array<struct<start:double,end:double,label:string,prob:double,p_noburst:double,kept:boolean>>, kind string"


def test_page(spark, tmp_path):
    clips = [
        ("b", None, 1.25, 2, 2, "A <warm> voice.", "Oh (Laugh)\nwell", [("Oh\nwell", "Warm.", "Laugh", "Warm, with a (Laugh)."), (None, None, None, None)], [(0.0, 0.5, "Laugh", 0.9, 0.1, True), (0.6, float("nan"), None, None, 0.8, False)], "wild"),
        ("a", None, None, None, 0, None, "", [], [], "wild"),
        ("c", "bad <file>", None, None, None, None, None, None, None, None),
    ]
    path = str(tmp_path / "index.html")
    assert report.page(spark.createDataFrame(clips, CLIP), path, "A & B", F.col("kind"), "x < y") == 5
    head, *lines, tail = open(path, encoding="utf-8").read().strip().split("\n")
    assert "<title>A &amp; B</title>" in head and "<p>x &lt; y</p>" in head and tail == "</body></html>"
    assert lines[0] == "<p>: 0 clips, 1 errors, 0 spans</p>" and lines[1] == "<p>wild: 2 clips, 0 errors, 2 spans</p>"
    # by kind, then by clip
    assert [line.split("<h3>")[1].split(" ")[0] for line in lines[2:]] == ["c", "a", "b"]
    assert "bad &lt;file&gt;" in lines[2] and "nothing said, no bursts" in lines[3] and "? s, 0 words" in lines[3]
    b = lines[4]
    assert 'Oh <span class="burst">(Laugh)</span><br>well' in b and "A &lt;warm&gt; voice." in b and "1.3 s, 2 words" in b
    assert "0.0–0.5 s: " in b and "Laugh (0.90)" in b and "0.6–? s: " in b and "no burst by 0.80" in b and '<span class="off">no burst</span>' in b


def test_page_of_nothing(spark, tmp_path):
    assert report.page(spark.createDataFrame([], CLIP), str(tmp_path / "p.html"), "t", F.lit("k")) == 0
    assert open(tmp_path / "p.html").read().endswith("</body></html>\n")


def _files(spark, tmp_path):
    rows = [(g, d, float(v)) for g, d in (("trait", "WARM"), ("trait", "FAST"), ("emotion", "JOY")) for v in range(-5, 6)]
    spark.createDataFrame(rows, "grp string, dim string, value double").write.parquet(str(tmp_path / "scores"))
    cli.main(["baseline", str(tmp_path / "scores"), "--out", str(tmp_path / "base.json")], spark)
    (tmp_path / "words.json").write_text(json.dumps({"WARM": ["warm", "cold", "warm", "cold"], "FAST": ["fast", "slow", "fast", "slow"]}))
    return ["--baseline", str(tmp_path / "base.json"), "--words", str(tmp_path / "words.json")]


def test_caption_command(spark, tmp_path, monkeypatch, capsys):
    common = _files(spark, tmp_path)
    assert "3 dimensions" in capsys.readouterr().out
    docs = [{"id": "x", "dims": {"WARM": 12, "FAST": -9}, "emo": {"JOY": 8}}, {"dims": {"FAST": 12}}, {"dims": {"FAST": 12}}]
    (tmp_path / "p.json").write_text(json.dumps(docs))
    cli.main(["caption", str(tmp_path / "p.json"), *common], spark)
    got = capsys.readouterr().out.strip().split("\n")
    assert len(got) == 3 and sum("x [default]" in g and "warm" in g and "slow" in g for g in got) == 1 and sum("document-" in g and g.count("fast") == 1 for g in got) == 2
    monkeypatch.setattr("sys.stdin", io.StringIO(json.dumps(docs[0])))
    cli.main(["caption", "-", *common, "--kv", "1", "--ke", "0", "--json", "--seed", "3", "--shuffle"], spark)
    got = json.loads(capsys.readouterr().out)
    assert [d["dim"] for d in got["dims"]] == ["WARM"] and got["emotions"] == []
    cli.main(["caption", str(tmp_path / "p.json"), *common, "--template", "random", "--seed", "5", "--out", str(tmp_path / "out")], spark)
    out = spark.read.json(str(tmp_path / "out")).collect()
    assert len(out) == 3 and len({r["template"] for r in out} - {"random"}) >= 1 and all(r["text"] for r in out)


def test_text_of_an_array(spark):
    assert [r["entity_id"] for r in scans.predictions_from_text(spark, ' [{"id": "q"}, {"dims": {}}]').collect()] == ["q", None]


def test_numbered_distinct(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("é",), ("",)], "v string")
    assert sorted(map(tuple, stats.numbered_distinct(df, "v").collect())) == [(0, ""), (1, "a"), (2, "b"), (3, "é")]
    assert stats.numbered_distinct(df.filter("false"), "v").count() == 0
