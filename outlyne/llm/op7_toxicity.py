"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches.

Folding: lower case, homoglyphs of other scripts and full-width forms to Latin letters, marks and zero-width signs off, digits and
signs in words with letters (`1d10t`, `m@ron`, `a$$`, `shi7`; not ! or | at the end) to those letters, anything else between words to one space.
Where signs end a word the text is also read without those (`idiot$$$`); both readings are learned from, and the one that hits more is scored.

Lexicon: candidates are the beginnings of words (three to eight characters, the space after a short word included).  Their document
counts among toxic and clean training texts give a log-odds weight; those with enough toxic documents and a weight of MIN_WEIGHT or
more are kept.  A beginning, not a word, is what inflected forms share.  Copies of a text count once.

Exceptions: a hit together with the word before or after it is a phrase; phrases of MIN_DOCS clean training texts or more that clean texts use at
least as much as toxic ones, by the upper bound of their log-odds (EXCEPTION_BOUND standard errors), are exceptions, and their hits do not count.
The bar is one of certainty, so it does not rise with the input.

Score: each word that hits gives the largest weight of its matches; a logistic curve of the sum, of the sum over the number of words
and of the largest weight is fitted on about FIT_ROWS labelled rows (a stated sample: the least text hashes).

Scale: candidates are counted in each task before they are shuffled.  A candidate needs MIN_DOCS toxic documents, however many there
are: with MIN_WEIGHT that is enough for a 95 % lower bound of the log-odds above 0 (at 5 toxic and no clean ones the standard error is
1.48).  The lexicon is stored in the shared folder and loaded by the workers; the driver gets one row for each part.  Exceptions are stored as sorted 64-bit
hashes in ranges, which workers map and search; a phrase with the hash of an exception is taken for it.  Labels are broadcast only below a checked size.
A labelled text is known by a 64-bit hash of it and its label when copies are counted once.

Nulls: a null or empty text scores as a text without hits; null labels are not learned from; of repeated labels of a document the
largest counts.  Texts of any length are read whole.  Without toxic or without clean training rows all scores are the share of toxic ones.  An empty table gives an
empty result.  A null id is not held out and not learned from.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, arrow_rows, id_crc, maybe_broadcast, table
from .mapped import map_array, write_array
from .textkit import rest

SHORT, LONG = 3, 8
MIN_DOCS, MIN_WEIGHT, EXCEPTION_BOUND = 5, 2.5, 1.64
FIT_ROWS = 20_000
HELD = 200_000

# Letters of other scripts that look like Latin ones, by their Latin form.
_LOOKS = {"a": "аα", "b": "ƅ", "c": "сϲ", "d": "ԁ", "e": "еε", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј", "k": "кκ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "t": "тτ", "u": "υս", "v": "ν", "w": "ԝ", "x": "хχ", "y": "у", "z": "ᴢ"}
_FOLD = {ord(c): latin for latin, signs in _LOOKS.items() for c in signs} | {ord(c): None for c in "​‌‍⁠﻿­"}
_DIGITS = str.maketrans("013457@$!|", "oieastasil")
_SIGN = re.compile(r"[0-9@$!|]")
_MASKED = re.compile(r"(?<!\S)[^\s0-9@$!|]*+[0-9@$!|]\S*")  # a word with such a sign
_TO_LETTER = re.compile(r".*[^\W\d_]", re.S)  # a word up to its last letter
_TO_SIGN = re.compile(r".*(?:[^\W_]|[@$])", re.S)  # a word without the ! and | at its end, which are punctuation
_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[^\x00-\xff]")


def _all_signs(m: re.Match) -> str:
    w = m[0]
    if not _TO_LETTER.match(w):
        return w
    n = _TO_SIGN.match(w).end()
    return w[:n].translate(_DIGITS) + w[n:]


def _inner_signs(m: re.Match) -> str:
    w = m[0]
    to = _TO_LETTER.match(w)
    return w[: to.end()].translate(_DIGITS) + w[to.end() :] if to else w


def _spaced(t: str) -> str:
    words = _WORD.findall(t)
    return " " + " ".join(words) + " " if words else ""


def readings(text: str) -> tuple[str, ...]:
    """Words of a text in plain letters, one space before each and one after the last; where signs end a word a second time without those."""
    t = text.lower()
    if _ODD.search(t) or "­" in t:
        t = unicodedata.normalize("NFC", unicodedata.normalize("NFKC", t).translate(_FOLD))
    if not _SIGN.search(t):
        return (_spaced(t),)
    t, inner = _MASKED.sub(_all_signs, t), _MASKED.sub(_inner_signs, t)
    return (_spaced(t),) if t == inner else (_spaced(t), _spaced(inner))


def fold(text: str) -> str:
    """The first reading of a text."""
    return readings(text)[0]


def beginnings(folded: str) -> set[str]:
    """Candidates of a text."""
    out = set()
    for w in set(folded.split()):
        w = f" {w} "[: LONG + 1]
        out.update(w[:k] for k in range(SHORT + 1, len(w) + 1))
    return out


def _tally(make, keys: str):
    """Counts in each task what make(text) yields, for toxic and for clean texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good = Counter(), Counter()

        def rows():
            names = list(bad.keys() | good.keys())
            for a in range(0, len(names), 50_000):
                part = names[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([bad[x] for x in part], pa.int64()), pa.array([good[x] for x in part], pa.int64())], names=[keys, "bad", "good"])

        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                (bad if toxic else good).update(set().union(*map(make, readings(text))))
            if len(bad) + len(good) > HELD:
                yield from rows()
                bad.clear()
                good.clear()
        yield from rows()
        bad.clear()
        good.clear()
        rest()

    return run


def _store(root: str):
    """Writes the rows (gram, weight) of each task to the shared folder; gives the name of each part that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, weights, part = [], [], f"{root}/{TaskContext.get().partitionId()}"
        for batch in batches:
            grams += batch.column("gram").to_pylist()
            weights += batch.column("weight").to_pylist()
        if grams:
            write_array(f"{part}-grams", np.frombuffer("\n".join(grams).encode(), np.uint8))
            write_array(f"{part}-weights", np.array(weights, np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.string())], names=["part"])

    return run


def phrase_hash(phrase: str) -> int:
    h = xxhash.xxh64_intdigest(phrase.encode())
    return h - (1 << 64) if h >> 63 else h


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([phrase_hash(p) for p in batch.column("phrase").to_pylist()], pa.int64())], names=["h"])


def _store_hashes(root: str):
    """Writes the sorted hashes of each task; gives (first, part) of each part that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, found = f"{root}/{TaskContext.get().partitionId()}", [batch.column("h").to_numpy() for batch in batches]
        if sum(map(len, found)):
            h = np.unique(np.concatenate(found))
            write_array(part, h)
            yield pa.RecordBatch.from_arrays([pa.array([int(h[0])], pa.int64()), pa.array([part], pa.string())], names=["first", "part"])

    return run


class Lexicon:
    """Weighted beginnings of words, given or stored in parts, and exception phrases, given or stored as ranges (first, part) of hashes."""

    def __init__(self, weights: dict[str, float], exceptions: set[str] = frozenset(), curve: tuple[float, ...] | None = None, parts: tuple[str, ...] = (), ranges: tuple[tuple[int, str], ...] = ()):
        self.weights, self.exceptions, self.curve, self.parts, self.ranges = weights, exceptions, curve, parts, ranges
        self._machine = None

    def __getstate__(self):
        return self.weights, self.exceptions, self.curve, self.parts, self.ranges

    def __setstate__(self, state):
        self.weights, self.exceptions, self.curve, self.parts, self.ranges = state
        self._machine = None

    def excepted(self, phrase: str) -> bool:
        if phrase in self.exceptions:
            return True
        h = phrase_hash(phrase)
        k = bisect_right(self.ranges, h, key=lambda r: r[0]) - 1
        if k < 0:
            return False
        known = map_array(self.ranges[k][1], np.int64)
        at = np.searchsorted(known, h)
        return bool(at < len(known) and known[at] == h)

    def entries(self) -> Iterator[tuple[str, float]]:
        yield from self.weights.items()
        for part in self.parts:
            yield from zip(map_array(f"{part}-grams", np.uint8).tobytes().decode().split("\n"), map_array(f"{part}-weights", np.float64).tolist())

    def hits(self, folded: str) -> dict[int, float]:
        """Where a word hits (the place of the space before it) and the largest weight of its matches."""
        if not folded or not (self.weights or self.parts):
            return {}
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for w, x in self.entries():
                self._machine.add_word(w, (len(w), x))
            self._machine.make_automaton()
        out: dict[int, float] = {}
        for end, (n, x) in self._machine.iter(folded):
            at = end - n + 1
            if x > out.get(at, 0.0):
                out[at] = x
        return out

    def phrases(self, folded: str) -> Iterator[tuple[int, str]]:
        """(place, phrase) of each hit with its neighbours."""
        for at in self.hits(folded):
            end = folded.index(" ", at + 1)
            word = folded[at + 1 : end]
            if at:
                yield at, folded[folded.rindex(" ", 0, at) + 1 : at] + " " + word
            if end + 1 < len(folded):
                yield at, word + " " + folded[end + 1 : folded.index(" ", end + 1)]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Of the reading that hits most."""
        return max(map(self._features, readings(text or "")))

    def _features(self, folded: str) -> tuple[float, float, float]:
        hits = self.hits(folded)
        if hits and (self.exceptions or self.ranges):
            for at in {at for at, p in self.phrases(folded) if self.excepted(p)}:
                hits.pop(at)
        total = sum(hits.values())
        words = max(1, folded.count(" ") - 1)
        return math.log1p(total), 100.0 * total / words / (1 + 10 * total / words), max(hits.values(), default=0.0)

    def score(self, text: str | None) -> float:
        x = self.features(text)
        z = self.curve[0] + sum(w * v for w, v in zip(self.curve[1:], x))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, turns: int = 60) -> np.ndarray:
    """Weights of a logistic curve by Newton steps, the constant first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge * len(x) / 1000] * (x.shape[1] - 1))
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(ws: Workspace, labelled: DataFrame) -> Lexicon:
    """A lexicon from rows (doc_id, text, toxic)."""
    rows = labelled.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    # of equal texts with equal labels one row
    rows = rows.withColumn("h", F.xxhash64("text", "toxic"))
    one = ws.put("one", rows.groupBy("h").agg(F.min("doc_id").alias("doc_id")).select("doc_id"))
    n = one.count()
    rows = rows.join(maybe_broadcast(one, n, 16), "doc_id", "left_semi")
    count = dict(rows.groupBy("toxic").count().collect())
    bad, good = count.get(1, 0), count.get(0, 0)
    if not bad or not good:
        share = (bad + 1e-9) / (bad + good + 1e-9) if bad else 0.0
        return Lexicon({}, frozenset(), (math.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0, 0.0, 0.0))
    log_odds = lambda: F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    grams = rows.mapInArrow(_tally(beginnings, "gram"), "gram string, bad long, good long").groupBy("gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    grams = grams.filter(F.col("bad") >= MIN_DOCS).withColumn("weight", log_odds()).filter(F.col("weight") >= MIN_WEIGHT).select("gram", "weight")
    parts = ws.put("lexicon", grams.mapInArrow(_store(f"{ws.root}/grams"), "part string")).collect()
    lexicon = Lexicon({}, parts=tuple(sorted(r["part"] for r in parts)))

    def pairs(folded: str) -> set[str]:
        return {p for _, p in lexicon.phrases(folded)}

    phrases = rows.mapInArrow(_tally(pairs, "phrase"), "phrase string, bad long, good long").groupBy("phrase").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    doubt = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    phrases = phrases.filter(F.col("good") >= MIN_DOCS).filter(log_odds() + EXCEPTION_BOUND * doubt <= 0)
    hashes = ws.put("exceptions", phrases.mapInArrow(_hashed, "h long"))
    stored = ws.put("ranges", hashes.repartitionByRange("h").mapInArrow(_store_hashes(f"{ws.root}/phrases"), "first long, part string"))
    lexicon.ranges = tuple(sorted((r["first"], r["part"]) for r in stored.collect()))
    # the curve, on the rows with the least hashes: about FIT_ROWS of them
    sample = rows.filter(F.col("h") < F.lit(2**64 * FIT_ROWS // n - 2**63)) if n > FIT_ROWS else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = [lexicon.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array([v[i] for v in f], pa.float64()) for i in range(3)]], names=["toxic", "a", "b", "c"])

    fitted = np.array(sample.mapInArrow(run, "toxic int, a double, b double, c double").collect(), float).reshape(-1, 4)
    if len(set(fitted[:, 0].tolist())) < 2:
        lexicon.curve = (math.log(bad / good), 1.0, 0.0, 0.0)
    else:
        lexicon.curve = tuple(float(w) for w in logistic(fitted[:, 1:], fitted[:, 0]))
    return lexicon


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of training documents: crc32 of the id modulo 5 is not 0."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(id_crc(F.col("doc_id")) % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(maybe_broadcast(known, labels.count(), 16), "doc_id")


def score(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text); row: an integer column that the result has too."""
    spark = docs.sparkSession
    ws = Workspace(spark, "toxicity")
    with arrow_rows(spark):
        lexicon = learn(ws, labelled_rows(docs, labels))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                s = [lexicon.score(t) for t in batch.column("text").to_pylist()]
                kept = ["doc_id", "held_out", *carried]
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], names=[*kept, "score", "predicted"])
            rest()

        carried = ["row"] if row else []
        held = F.coalesce(id_crc(F.col("doc_id")) % 5 == 0, F.lit(False)).alias("held_out")
        texts = docs.select("doc_id", held, *([F.col(row).cast("long").alias("row")] if row else []), "text")
        schema = "doc_id long, held_out boolean, " + "row long, " * len(carried) + "score double, predicted int"
        out = ws.put("scores", texts.mapInArrow(run, schema), narrow=True)
        return out.withColumnRenamed("row", row) if row else out


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
