"""The pipeline against plain restatements of its stages."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

from ..twins import SF as SMALL
from ..twins import duck
from .brute import jaccard_components, words

SF = SMALL.replace("sf0.001", "sf0.01")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, each stage fed with its predecessor's rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS)
    ws = cp.Workspace(spark, "test")
    out = [docs]
    for i, (_, f) in enumerate(cp.STAGES):
        out.append(ws.put(f"s{i}", f(spark, out[-1], SF)))
    return out


def ids(df):
    return collections.Counter(r[0] for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert len(cp.STAGES) == 5 and all(s.columns == COLUMNS for s in stages[:-1]) and cp.ORACLE_SQL is None


def test_toxicity_follows_scores(spark, stages):
    bad = {r["doc_id"] for r in cp.op7_toxicity.op7_toxicity(spark, SF).collect() if r["predicted"] == 1}
    assert bad and set(ids(stages[1])) == set(ids(stages[0])) - bad
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(ids(stages[0])) - set(ids(stages[1]))
    assert sum(labels.get(d, 1) == 0 for d in gone) <= 0.02 * len(labels)


def test_copies(stages):
    keep = {}
    for r in stages[1].collect():
        keep[r["text"]] = max(keep.get(r["text"], -1), r["doc_id"])
    assert set(ids(stages[2])) == set(keep.values())


def test_near_copies(stages):
    comp = jaccard_components([(r["doc_id"], r["text"]) for r in stages[2].collect()])
    assert set(ids(stages[3])) == {d for d, (_, c) in comp.items() if d == c}


def test_mixing(stages, spark, tmp_path):
    stages[3].coalesce(1).toPandas().to_parquet(tmp_path / "documents.parquet")
    sql = cp.op6_mixing.ORACLE.replace("FROM documents)", f"FROM '{tmp_path}/documents.parquet')", 1)
    names, rows = duck(sql)
    want = {r[names.index("doc_id")]: r[names.index("taken")] for r in rows}
    got = ids(stages[4])
    size = {r["doc_id"]: len(words(r["text"])) for r in stages[3].collect()}
    assert {d: n for d, n in want.items() if n} == {d: k * size[d] for d, k in got.items() if size[d]} and max(got.values()) == 2


def test_tokens(stages):
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(cp.op9_bpe.default_path())
    text = {r["doc_id"]: r["text"] for r in stages[4].collect()}
    assert ids(stages[5]) == ids(stages[4])
    for r in stages[5].collect():
        want = ref.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, stages):
    a = sorted((r["doc_id"], r["ids_sha256"]) for r in cp.run(spark, SF).collect())
    assert a == sorted((r["doc_id"], r["ids_sha256"]) for r in stages[5].collect())


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, turns int, h long, row long"
    long, more = "w " * 30_000, [(1, 1, 1)]
    rows = [(None, "a b", None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, long, "en", "s", 1), (4, long, "en", "t", 1)]
    for docs in (spark.createDataFrame([(*r, *more[0]) for r in rows], schema), spark.createDataFrame([], schema)):
        for _, f in cp.STAGES[:-1]:
            docs = f(spark, docs, SF)
            assert docs.columns == COLUMNS
        last = cp.STAGES[-1][1](spark, docs, SF)
        assert last.filter(F.col("n_tokens") < 0).count() == 0


def kept(stage, spark, rows):
    docs = spark.createDataFrame([(d, t, "en", s, None) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in stage(spark, docs, SF).collect()), key=repr)


def test_copies_of_rows_with_equal_or_null_ids(spark):
    rows = [(5, "A text", "s"), (5, "B text", "s"), (9, "B text", "s"), (7, "C", "s"), (7, "C", "s"), (None, "D", "s"), (None, "D", "s"), (None, "C", "s"), (1, "", "s"), (None, None, "s")]
    assert kept(cp.drop_copies, spark, rows) == sorted([(5, "A text", "s"), (9, "B text", "s"), (7, "C", "s"), (None, "D", "s"), (1, "", "s")], key=repr)


def test_near_copies_of_rows_with_equal_or_null_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a, "s"), (5, b, "s"), (3, a + " end", "s"), (None, b + " end", "s"), (8, "", "s"), (8, None, "s"), (None, "few words", "s"), (None, "few words", "s")]
    assert kept(cp.drop_near_copies, spark, rows) == sorted([(3, a + " end", "s"), (5, b, "s"), (8, "", "s"), (8, None, "s"), (None, "few words", "s")], key=repr)


def test_toxic_rows_with_equal_or_null_ids(spark, stages):
    bad = min((r["doc_id"] for r in stages[0].join(stages[1], "doc_id", "left_anti").collect()))
    text = {r["doc_id"]: r["text"] for r in stages[0].collect()}
    good = min(ids(stages[1]))
    # the labelled rows come along, so that there is something to learn from
    docs = stages[0].unionByName(spark.createDataFrame([(None, text[bad], "en", "planted", None), (good, text[bad], "en", "planted", None), (bad, text[good], "en", "planted", None)], stages[0].schema))
    left = [(r["doc_id"], r["text"]) for r in cp.drop_toxic(spark, docs, SF).filter("source = 'planted'").collect()]
    assert left == [(bad, text[good])]


def test_mixing_of_rows_with_equal_or_null_ids(spark):
    rows = [(1, "one two", "s"), (1, "one two", "s"), (1, "three", "s"), (None, "four", "s"), (None, "four", "s"), (None, None, None)]
    got = kept(cp.mix_sources, spark, rows)
    words_taken = sum(len(words(t)) for _, t, _ in got)
    assert {t for _, t, _ in got if t} == {"one two", "three", "four"} and words_taken in (9, 10, 11, 12)
