import io
import json
import tarfile
import wave

import numpy as np
import pytest

from outlyne.operators import records
from outlyne.sources import archives, documents, rejects, scans, sinks


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "x", "dims": {"A": 1}}))
    (tmp_path / "b.json").write_text(json.dumps([{"id": "y", "dims": {}}, {"id": "z"}]))
    assert sorted(r["entity_id"] for r in scans.predictions(spark, str(tmp_path / "*.json")).collect()) == ["x", "y", "z"]
    assert scans.predictions_from_text(spark, '{"id": "q"}').first()["entity_id"] == "q"
    assert scans.files(spark, str(tmp_path / "*.json")).count() == 2


def test_baseline_round_trip(spark, tmp_path):
    stats = spark.createDataFrame([("b", 1.0, 0.5, "trait", ["s"]), ("a", 2.0, 1.5, "emotion", None)], "dim string, median double, spread double, grp string, synonyms array<string>")
    assert documents.baseline(stats, str(tmp_path / "b.json"), {"seed": 1}) == 2
    assert list(json.loads((tmp_path / "b.json").read_text())) == ["_meta", "a", "b"]
    got = {r["dim"]: r for r in scans.baseline_document(spark, str(tmp_path / "b.json")).collect()}
    assert set(got) == {"a", "b"} and got["b"]["spread"] == 0.5 and got["b"]["synonyms"] == ["s"] and got["a"]["grp"] == "emotion"
    assert {r["grp"] for r in scans.baseline_document(spark, str(tmp_path / "b.json"), {"trait": "x"}).collect()} == {"x", "emotion"}
    sinks.stage(stats, str(tmp_path / "st"))
    assert scans.baseline_table(spark, str(tmp_path / "st")).count() == 2


def test_parquet_files(spark, tmp_path):
    for i in range(3):
        spark.range(i + 1).selectExpr("id", "id * 2 AS other").coalesce(1).toPandas().to_parquet(tmp_path / f"scores-{i}.parquet")
    assert scans.parquet_files(spark, str(tmp_path), "scores-*.parquet", ["id"]).count() == 6
    assert scans.parquet_files(spark, str(tmp_path), "scores-*.parquet", ["id"], first=2).count() == 3


def test_archives_and_audio(spark, tmp_path):
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(np.array([[16384, 0]] * 80, "<i2").tobytes())
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        for name, data in (("a.wav", buf.getvalue()), ("b.wav", b"broken"), ("c.txt", b"x"), ("d.wav", buf.getvalue())):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    whole = (tmp_path / "t.tar").read_bytes()
    (tmp_path / "cut.tar").write_bytes(whole[:1100])
    (tmp_path / "none.tar").write_bytes(b"no archive")
    kept = {(r["archive"].rsplit("/", 1)[1], r["key"]) for r in scans.tar_members(spark, str(tmp_path / "*.tar"), ".wav").collect()}
    assert {k for f, k in kept if f == "t.tar"} == {"a", "b", "d"}
    assert {x for x in kept if x[0] != "t.tar"} == {("cut.tar", "a")}  # what comes before the break
    m = scans.tar_members(spark, str(tmp_path / "t.tar"), ".wav", ["a", "b"])
    got = {r["key"]: r for r in scans.decode_audio(m, "key", "content").collect()}
    assert set(got) == {"a", "b"} and len(got["a"]["samples"]) == 160 and abs(got["a"]["samples"][0] - 0.25) < 1e-6
    assert got["b"]["samples"] is None and got["b"]["error"]


def sums(df):
    return {(r["archive"].rsplit("/", 1)[1], r["id"]): sum(r["embedding"]) for r in df.collect()}


def test_arrays_in_runs_of_rows(spark, tmp_path):
    x = np.arange(6400).reshape(100, 64) % 97
    np.savez(tmp_path / "half.npz", ids=np.array([f"é{i}" for i in range(100)]), emb=x.astype(np.float16))
    np.savez_compressed(tmp_path / "small.npz", emb=x.astype(np.float64), ids=np.arange(100))
    np.savez(tmp_path / "none.npz", ids=np.array([], str), emb=np.zeros((0, 4)))
    np.savez(tmp_path / "odd.npz", ids=np.arange(3), emb=np.zeros((4, 2)))
    np.savez(tmp_path / "objects.npz", ids=np.array([{}, []], object), emb=np.zeros((2, 2)))
    whole = (tmp_path / "half.npz").read_bytes()
    (tmp_path / "cut.npz").write_bytes(whole[: len(whole) // 2])
    good, bad = rejects.parted(archives.npz_rows(spark, str(tmp_path / "*.npz"), piece=1 << 10))
    want = {("half.npz", f"é{i}"): float(r.sum()) for i, r in enumerate(x)} | {("small.npz", str(i)): float(r.sum()) for i, r in enumerate(x)}
    assert sums(good) == want and good.count() == 200
    assert sorted(r["archive"].rsplit("/", 1)[1] for r in bad.collect()) == ["cut.npz", "objects.npz", "odd.npz"] and all(r["error"] for r in bad.collect())


def test_archive_larger_than_a_row(spark, tmp_path):
    """A sparse archive of 2.5 GB: its small members are read by several tasks, the 2.4 GB member is passed over, and none of it is read for the index."""
    with open(tmp_path / "big.tar", "wb") as f:
        def member(name, data, size=None):
            info = tarfile.TarInfo(name)
            info.size = len(data) if size is None else size
            f.write(info.tobuf(tarfile.GNU_FORMAT))
            f.write(data)
            f.seek(-f.tell() % 512 if size is None else f.tell() + -(-size // 512) * 512, 1 if size is None else 0)
        for i in range(40):
            member(f"a{i}.txt", b"x" * (1 << 20))
        member("huge.bin", b"", 2_400_000_000)
        for i in range(40):
            member(f"b{i}.txt", b"y" * 1000)
        f.truncate(f.tell() + 1024)
    assert (tmp_path / "big.tar").stat().st_size > 2**31
    m = archives.tar_members(spark, str(tmp_path / "big.tar"), ".txt", piece=4 << 20)
    got = m.selectExpr("key", "length(content) AS n", "error", "spark_partition_id() AS task").collect()
    assert {(r["key"], r["n"]) for r in got} == {(f"a{i}", 1 << 20) for i in range(40)} | {(f"b{i}", 1000) for i in range(40)} and len(got) == 80
    assert len({r["task"] for r in got}) > 3 and not any(r["error"] for r in got)


def test_archive_rejects_keys_and_removal(spark, tmp_path):
    def archive(name, mode="w"):
        with tarfile.open(tmp_path / name, mode) as t:
            for i in range(5):
                info = tarfile.TarInfo(f"m{i}.txt")
                info.size = 1000
                t.addfile(info, io.BytesIO(bytes([65 + i]) * 1000))
            t.addfile(tarfile.TarInfo("other.bin"))
    archive("a.tar"), archive("b.tar.gz", "w:gz")
    whole = (tmp_path / "a.tar").read_bytes()
    (tmp_path / "cut.tar").write_bytes(whole[:2500])
    (tmp_path / "none.tar").write_bytes(b"no archive" * 100)
    zipped = (tmp_path / "b.tar.gz").read_bytes()
    (tmp_path / "cut.tar.gz").write_bytes(zipped[: len(zipped) // 2])
    (tmp_path / "empty.tar").write_bytes(b"")
    good, bad = rejects.parted(archives.tar_members(spark, f"{tmp_path}/*.tar*", ".txt", piece=1024))
    name = lambda r: r["archive"].rsplit("/", 1)[1]
    listed = {(name(r), r["key"], bytes(r["content"][:1])) for r in good.collect() if not name(r).startswith("cut.tar.gz")}
    assert listed == {(f, f"m{i}", bytes([65 + i])) for f in ("a.tar", "b.tar.gz") for i in range(5)} | {("cut.tar", "m0", b"A")}
    found = {(name(r), r["key"]) for r in bad.collect()}
    assert found >= {("cut.tar", "m1"), ("cut.tar", None), ("none.tar", None), ("cut.tar.gz", None)} and bad.columns == ["archive", "key", "content", "error"]
    keys = spark.createDataFrame([("m3",), ("m3",), ("none",)], "key string")
    some = archives.tar_members(spark, f"{tmp_path}/[ab].tar*", ".txt", keys).collect()
    assert sorted((name(r), r["key"], len(r["content"])) for r in some) == [("a.tar", "m3", 1000), ("b.tar.gz", "m3", 1000)]
    assert archives.remove(spark, f"{tmp_path}/*.tar") == 3 and sorted(x.name for x in tmp_path.iterdir()) == ["b.tar.gz", "cut.tar.gz", "empty.tar"]


def test_documents(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "concat('é\"', id) AS name", "CAST(NULL AS STRING) AS none").repartition(7)
    assert documents.results(df, str(tmp_path / "r.json"), ["id"]) == 5000
    doc = json.loads((tmp_path / "r.json").read_text())
    assert doc["n"] == 5000 and doc["results"] == [{"id": i, "name": f'é"{i}', "none": None} for i in range(5000)]
    assert documents.combined(df.limit(0), str(tmp_path / "c.json"), ["id"]) == 0 and json.loads((tmp_path / "c.json").read_text()) == []
    assert documents.one_file_each(df.filter("id < 20"), str(tmp_path / "each"), "id") == 20
    assert {x.name for x in (tmp_path / "each").iterdir()} == {f"{i}.json" for i in range(20)} and json.loads((tmp_path / "each" / "7.json").read_text())["id"] == 7
    assert sorted(x.name for x in tmp_path.iterdir()) == ["c.json", "each", "r.json"]  # no parts are left


def test_documents_are_read_in_pieces(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(3000).selectExpr("id", "concat('é,\\n]\"', repeat('x', int(id % 90))) AS name", "CAST(NULL AS STRING) AS none")
    at, kind = str(tmp_path / "r.json"), "id bigint, name string, none string"
    documents.results(df, at, ["id"])
    want = [(r["id"], r["name"]) for r in df.orderBy("id").collect()]
    for piece in (37, 4096, 1 << 20):  # lines are longer than the shortest pieces
        got = documents.results_rows(spark, at, kind, piece)
        assert [(r["r"]["id"], r["r"]["name"]) for r in got.orderBy("pos").collect()] == want
        assert got.agg(F.min("n"), F.max("n"), F.min("pos"), F.max("pos")).first()[:] == (3000, 3000, 0, 2999)
    # no task reads the document alone
    assert documents.results_rows(spark, at, kind, 4096).select(F.spark_partition_id().alias("p")).distinct().count() > 4
    for write in (documents.results, documents.combined):
        write(df.limit(0), str(tmp_path / "none.json"), ["id"])
        assert documents.rows(spark, str(tmp_path / "none.json"), kind).count() == 0
    documents.combined(df, str(tmp_path / "c.json"), ["id"])
    assert [r["r"]["name"] for r in documents.rows(spark, str(tmp_path / "c.json"), kind, 5000).orderBy("pos").collect()] == [n for _, n in want]
    (tmp_path / "other.json").write_text('[{"id": 1}, {"id": 2}]')
    with pytest.raises(Exception, match="line of their own"):
        documents.rows(spark, str(tmp_path / "other.json"), kind).collect()


def test_json_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x", "dims": {}}')
    (tmp_path / "b.json").write_text('{"id": ')
    (tmp_path / "c.json").write_text('[{"id": "y"}, {"dims": {}}]')
    (tmp_path / "d.json").write_text(" ")
    good, bad = rejects.parted(scans.checked_predictions(spark, str(tmp_path)))
    assert sorted(r["key"] for r in good.collect()) == ["x", "y"]
    assert sorted((r["archive"].rsplit("/", 1)[1], r["error"]) for r in bad.collect()) == [("b.json", "not JSON"), ("c.json", "no id"), ("d.json", "not JSON")]


def test_taxonomies(spark, tmp_path):
    doc = {"meta": {"n": 3}, "categories": {"z_first": {"items": {"Zed": {"description": "d1", "group": "z_first"}, "Abe": {"description": "d2"}}}, "a_second": {"items": {"Cat": {"description": "d3"}}}}}
    (tmp_path / "t.json").write_text(json.dumps(doc))
    got = [(r["class_ix"], r["class"], r["grp"], r["description"]) for r in scans.taxonomy(spark, str(tmp_path / "t.json")).orderBy("class_ix").collect()]
    assert got == [(0, "Zed", "z_first", "d1"), (1, "Abe", "z_first", "d2"), (2, "Cat", "a_second", "d3"), (3, "no_burst", None, None)]
    (tmp_path / "s.json").write_text(json.dumps({"categories": {"Joy": {"keywords": ["glee"]}, "Fear": {}}}))
    assert {r["dim"]: r["synonyms"] for r in scans.synonyms(spark, str(tmp_path / "s.json")).collect()} == {"Joy": ["glee"], "Fear": []}


def test_json_rejects_in_folders(spark, tmp_path):
    import gzip

    from pyspark.sql import functions as F

    df = spark.range(300).selectExpr("id", "IF(id % 3 = 0, '{\"id\": ', concat('{\"id\": \"', id, '\"}')) AS t")
    assert documents.texts_each(df, str(tmp_path), F.col("id"), F.col("t"), folders=16) == 300
    assert len(list(tmp_path.iterdir())) == 16  # each is listed by a task of its own
    (tmp_path / "top.json").write_text('[{"id": "é"}, {"dims": {}}]')
    (tmp_path / "3" / "packed.json.gz").write_bytes(gzip.compress(b'{"id": "z"}'))
    for name in ("empty.json", "_hidden.json", ".hidden.json"):
        (tmp_path / name).write_text("" if name == "empty.json" else "{}")
    texts = documents.texts_of(spark, str(tmp_path))
    good, bad = rejects.parted(scans.checked_of(texts))
    assert sorted(r["key"] for r in good.collect()) == sorted([str(i) for i in range(300) if i % 3] + ["é", "z"])
    assert sorted(r["error"] for r in bad.collect()) == ["no id"] + ["not JSON"] * 100
    assert all(r["archive"].startswith("file:/") for r in bad.collect()) and texts.select(F.spark_partition_id()).distinct().count() > 2
    old = scans.checked_predictions(spark, str(tmp_path / "3"))  # the same rows as Spark's reader gives
    assert sorted(map(str, old.collect())) == sorted(map(str, scans.checked_of(documents.texts_of(spark, f"file://{tmp_path}/3")).collect()))


def test_record_files_in_folders(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(60).selectExpr("concat('{\"id\": \"', id, '\", \"sentences\": [{\"text\": \"A\", \"bursts\": [\"B\"]}]}') AS t", "id")
    documents.texts_each(df, str(tmp_path), F.col("id"), F.col("t"), folders=4)
    (tmp_path / "0" / "two.json").write_text('[{"id": "x"}, {"id": "y", "ei_gender": 1}]')
    got = {r["id"]: r for r in scans.records_of(documents.texts_of(spark, str(tmp_path))).collect()}
    assert set(got) == {str(i) for i in range(60)} | {"x", "y"} and got["7"]["sentences"][0]["bursts"] == ["B"] and got["x"]["sentences"] is None


def test_records(spark, tmp_path):
    from outlyne.model import Config

    clips = spark.createDataFrame([("c", 1.0)], "clip string, ei_gender double").selectExpr("*", "CAST(NULL AS STRING) AS global_scores")
    sent = spark.createDataFrame([("c", 1, "Two.", 1.0, 2.0), ("c", 0, "One.", 0.0, 1.0)], "clip string, ix int, text string, start double, end double")
    bursts = spark.createDataFrame([("c", 1, 0.9, 1.1, "Sigh")], "clip string, b_ix long, start double, end double, label string")
    r = records.score_record(clips, sent, bursts, Config()).first()
    assert [(s["text"], s["bursts"]) for s in r["sentences"]] == [("One.", ["Sigh"]), ("Two.", ["Sigh"])]
    (tmp_path / "r.json").write_text(json.dumps({"id": "c", "ei_gender": 1.4, "global_scores": {"dims": {"A": 1}, "genu": 2}, "sentences": [{"text": "Hi.", "bursts": ["Soft Sigh"]}]}))
    got = scans.records(spark, str(tmp_path / "r.json")).first()
    assert got["global_scores"]["dims"] == {"A": 1.0} and got["sentences"][0]["bursts"] == ["Soft Sigh"]
    lines = spark.createDataFrame([("c", 0, "tags", "Hi.", ["A", "B"]), ("c", 1, "t", "Bye.", [])], "clip string, ix int, cue string, text string, bursts array<string>")
    assert [x["text"] for x in records.rerender_lines(lines).orderBy("ix").collect()] == ["Hi (A) (B)", "Bye."]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "x(y)", None), ("a", None, "bad")], "id string, text string, error string")
    assert sinks.results(df, str(tmp_path / "o")) == 2
    html = {r["id"]: r["html"] for r in sinks.cards(df, "id", "text", "error").collect()}
    assert "ERROR: bad" in html["a"] and 'class="burst">(y)' in html["b"]
    sinks.folder_each(df, str(tmp_path / "each"), "id")
    assert spark.read.json(str(tmp_path / "each")).count() == 2


def test_stream_windows(spark, tmp_path):
    from pyspark.sql import functions as F

    from outlyne.streaming.live import score_stream, windowed_deviation

    base = spark.createDataFrame([("a", 1.0, 1.0, 1.0, 1.0)], "dim string, median double, std double, mad double, spread double")
    spark.createDataFrame([(float(i), f"2024-01-01 00:{i:02d}:00") for i in range(10)], "value double, t string").selectExpr("value", "CAST(t AS TIMESTAMP_NTZ) AS ts").write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema("value double, ts timestamp_ntz").parquet(str(tmp_path / "in"))
    live = score_stream(raw.withColumn("dim", F.lit("a")), base)
    windowed_deviation(live, "ts").writeStream.outputMode("complete").format("memory").queryName("win").trigger(availableNow=True).start().awaitTermination(60)
    assert [(r["n"], round(r["max_abs_z"])) for r in spark.table("win").collect()] == [(10, 8)]


def test_heads_on_sequences(spark):
    import math

    from outlyne.operators import infer

    x = np.linspace(-8, 8, 400)
    assert np.abs(infer.erf(x) - [math.erf(v) for v in x]).max() < 1e-14
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]]), (2, None), (3, [[0.5, 0.5], [0.5, 0.5]]), (4, [[1.0, 1.0]])], "id long, v array<array<double>>")
    conv = infer.Net([("conv", np.ones((1, 2, 1)), np.zeros(1))])
    assert {r["id"]: r["scores"] for r in infer.run_classifier(df, "id", "v", conv).collect()} == {1: [3.0, 7.0], 2: None, 3: [1.0, 1.0], 4: [2.0]}
    flat = infer.Net([("linear", np.array([[1.0, 1.0, 1.0, 10.0]]), np.zeros(1))])
    assert {r["id"]: r["value"] for r in infer.run_heads(df.filter("id < 4"), "id", "v", {"h": flat}).collect()} == {1: 46.0, 2: None, 3: 6.5}


def test_layers_that_a_worker_holds(spark, monkeypatch):
    from outlyne.operators import infer

    rows = [(h, n, o, [((i * 3 + o + n + len(h)) % 5 - 2) / 4.0 for i in range(a)], o / 8.0) for h in ("a", "bb") for n, (a, b) in enumerate(((4, 3), (3, 3), (3, 2))) for o in range(b)]
    w = spark.createDataFrame(rows, "head string, layer int, out int, w array<double>, b double")
    df = spark.createDataFrame([(1, [[1.0, -2.0], [3.0, 0.5]]), (2, None), (3, [[1.0], [2.0]]), (4, [[0.5, None], [1.0, 1.0]]), (5, [[float("nan"), 1.0], [1.0, 1.0]]), (6, [[0.25, 1.0], [-1.0, 9.0]])], "id long, v array<array<double>>")
    after = [["norm", "gelu"], ["relu"], ["sigmoid"]]
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    read = lambda d: sorted((r["id"], r["head"], str([None if v is None else round(v, 9) for v in r["values"]])) for r in d.collect())
    held = infer.layered(df, "id", "v", w, after)
    assert "MapInArrow" in plan(held)  # no join of each layer for rows that fit
    got = read(held)
    monkeypatch.setattr(infer, "HELD", 0)
    joined = infer.layered(df, "id", "v", w, after)
    assert "MapInArrow" not in plan(joined) and read(joined) == got and [k for k, _, _ in got] == [1, 1, 3, 3, 4, 4, 5, 5, 6, 6]
    monkeypatch.undo()
    part = infer.layered(df, "id", "v", w.filter("head = 'a' or layer < 2"), after)  # a head without its last layer gives nothing, as by joins
    assert "MapInArrow" not in plan(part) and {r["head"] for r in part.collect()} == {"a"}


def test_captions_are_parsed_once(spark):
    from outlyne.plans import queries

    plan = queries.QUERIES["k07_caption_json"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Union" not in plan  # one pass over the documents, whose layout is stored


def test_stage_tables_have_an_owner(spark):
    from pathlib import Path

    from outlyne.sources import stages

    at = lambda df: Path(df.inputFiles()[0].removeprefix("file://")).parent
    one = spark.range(3)
    free = stages.once(one, "free")
    with stages.owned(spark):
        a = at(stages.once(one, "a"))
        with stages.owned(spark):
            b = at(stages.once(one, "b"))
        assert a.exists() and not b.exists()
    assert not a.exists() and at(free).exists() and free.count() == 3
    try:
        with stages.owned(spark):
            a = at(stages.once(one, "a"))
            raise ValueError
    except ValueError:
        assert not a.exists()


def test_broadcast_counts_bytes(spark):
    from outlyne.sources import stages

    def hinted(df, **limits):
        return "ResolvedHint" in stages.small(df, **limits)._jdf.queryExecution().analyzed().toString()

    numbers, lists = spark.range(100), spark.range(100).selectExpr("id", "sequence(0, 999) AS l", "CAST(NULL AS string) AS s")
    assert hinted(numbers) and not hinted(numbers, rows=99) and hinted(numbers, size=0)
    assert hinted(lists) and not hinted(lists, size=100_000) and hinted(lists.filter("false"), size=0)
