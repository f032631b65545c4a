"""From raw documents to token ids: toxic documents go, of equal and of near-equal texts one stays, sources are mixed, texts become tokens.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.  Stages decide about
rows, not about ids: where ids repeat or are null, rows get numbers in a stored table, and a decision meets its own row only.

In every stage: a null text is an empty text and is passed on as null; texts of any length are read whole; extra columns are left out; an empty table
gives an empty result; the columns of the next one's docs are those of documents, unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlyne.llm import op1_jaccard_join, op6_mixing, op7_toxicity, op9_bpe, op10_exact_dedup
from outlyne.llm.common import Workspace, maybe_broadcast, numbered, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(ws: Workspace, docs: DataFrame) -> DataFrame:
    return numbered(ws, docs.select(*COLUMNS))[0]


def _without(ws: Workspace, docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs less the rows of gone (row).  They are broadcast only when their number has been found small."""
    gone = ws.put("gone", gone.select("row"))
    return docs.join(maybe_broadcast(gone, gone.count(), 16), "row", "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity score rejects go, those with a null or repeated id too; a row with an empty text is scored as such."""
    ws = Workspace(spark, "toxic")
    docs = _rows(ws, docs)
    scores = op7_toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), row="row")
    return _without(ws, docs, scores.filter("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: that of the largest id (a null id is least); of repeated rows one.  Empty and null texts are equal."""
    ws = Workspace(spark, "copies")
    docs = _rows(ws, docs)
    return _without(ws, docs, op10_exact_dedup.exact_groups(docs, row="row").filter("row <> keep_row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row stays: that of the smallest id (a null id is last), of several the first.  Texts without
    words are linked with nothing and stay."""
    ws = Workspace(spark, "near")
    docs = _rows(ws, docs)
    return _without(ws, docs, op1_jaccard_join.similarity_classes(docs, row="row").filter("row <> keep_row"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, twice at most.  Null is a source of its own."""
    ws = Workspace(spark, "turns")
    docs = _rows(ws, docs)
    turns = ws.put("turns", op6_mixing.mix(docs, row="row").filter("turns > 0").select("row", "turns"))
    taken = docs.join(maybe_broadcast(turns, turns.count(), 24), "row")
    return taken.withColumn("turn", F.explode(F.sequence(F.lit(1), "turns"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars with n_tokens, ids, and digests of the ids and of the text decoded from them, for every row."""
    return op9_bpe.digests(docs.select(*COLUMNS), with_ids=True)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near duplicates", drop_near_copies), ("mixing", mix_sources), ("byte-pair encoding", encode)]

#: Neither the learned toxicity score nor the tokenizer can be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        done = ws.put(f"{i}", stage(spark, docs, sf_dir))
        if i:
            ws.drop(f"{i - 1}")
        docs = done
    return docs
