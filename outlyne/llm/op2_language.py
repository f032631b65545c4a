"""Language identification by rank-order profiles (Cavnar & Trenkle, 1994).

A text is folded to lower-case letters with one mark between words; its n-grams of one to three characters are counted
and the TOP most frequent are ranked.  A language's profile is the same list over all its training texts.  The
out-of-place distance sums, over the text's n-grams, how far their ranks differ; one missing from the profile costs TOP.
The nearest profile wins; equal distances go to the first name.

Scale: each task adds up its texts' counts before they are shuffled as (lang, n-gram, count); a language that holds a third of
all rows arrives as one row for each task and n-gram.  Each task then keeps the TOP of what it holds of a language, so the task that
ranks a language gets at most TOP rows from each.  Profiles hold TOP rows a language and are all that reaches the driver.

Nulls: null text, or a text without a letter: `und`, score 0.  Rows without lang are not learned from.  Without any training row all
texts are `und`.  Repeated rows count each and get equal answers.  A null id is held out never and learned from never.
Texts of any length are read whole.
An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, arrow_rows, id_crc, table

TOP = 300
HELD = 500_000
_NONE = 0x1FFFFF  # marks the missing characters of a shorter n-gram
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of a text, ascending, and their counts; none for a text without a letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(_letter_table()[c], c, 0).astype(np.int64)
    c = np.concatenate(([0], c, [0, 0]))
    c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]
    if len(c) < 2 or not c.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.concatenate((c, [0]))
    three, n = np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:], return_counts=True)
    at = lambda x: np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1))
    two = three >> 21
    cut2 = at(two)
    one = three >> 42
    cut1 = at(one)
    keep3, keep2, keep1 = (two & _NONE) != 0, two[cut2] != 0, one[cut1] != 0
    codes = np.concatenate((three[keep3], (two[cut2] << 21 | _NONE)[keep2], (one[cut1] << 42 | _NONE << 21 | _NONE)[keep1]))
    counts = np.concatenate((n[keep3], np.add.reduceat(n, cut2)[keep2], np.add.reduceat(n, cut1)[keep1]))
    order = np.argsort(codes)
    return codes[order], counts[order]


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, most frequent first, equal counts by code."""
    return codes[np.argsort(-counts, kind="stable")[:top]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def rows():
        for lang, parts in held.items():
            codes, counts = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            codes, counts = gram_counts(text)
            held.setdefault(lang, []).append((codes, counts))
            size += len(codes)
        if size > HELD:
            held = {lang: [merged(p)] for lang, p in held.items()}
            size = sum(len(p[0][0]) for p in held.values())
            if size > HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def train(labelled: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, gram, rank) from rows (text, lang)."""
    rows = labelled.select("lang", "text").filter("lang is not null and text is not null")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    # compared bare, so that each task keeps its own first rows only before they are shuffled
    return counts.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "gram", (F.col("rank") - 1).alias("rank"))


class Profiles:
    """Ranks of all languages over the union of their n-grams."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int = TOP):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        self.codes = np.array(sorted({r[1] for r in rows}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.codes)), -1, np.int32)
        at = {lang: i for i, lang in enumerate(self.langs)}
        for lang, code, rank in rows:
            self.ranks[at[lang], np.searchsorted(self.codes, code)] = rank

    def guess(self, text: str | None) -> tuple[str, float]:
        codes = ranked(*gram_counts(text), self.top) if text and self.langs else ()
        if not len(codes):
            return "und", 0.0
        i = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        r = np.where(self.codes[i] == codes, self.ranks[:, i], -1)
        d = np.where(r < 0, self.top, np.abs(r - np.arange(len(codes)))).sum(axis=1)
        best = int(np.argmin(d))
        worst = float(self.top * len(codes))
        second = float(np.partition(d, 1)[1]) if len(d) > 1 else worst
        return self.langs[best], (second - float(d[best])) / second if second else 0.0


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Adds lang_pred and score to rows (doc_id, held_out, text) and drops the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [profiles.guess(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Learns from the rows of docs (doc_id, text, lang) that are not held out and predicts all."""
    ws = Workspace(docs.sparkSession, "language")
    held = id_crc(F.col("doc_id")) % 3 == 1
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held, F.lit(False)).alias("held_out"))
    with arrow_rows(docs.sparkSession):
        model = ws.put("profiles", train(rows.filter("doc_id is not null and not held_out"), top))
        profiles = Profiles([tuple(r) for r in model.collect()], top)  # TOP rows a language
        return ws.put("guesses", predict(rows, profiles), narrow=True)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
