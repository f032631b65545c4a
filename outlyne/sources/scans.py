"""Readers: score documents, baselines, taxonomies, records, archives, audio."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audio import wav_samples

STAT = "mean double, median double, std double, mad double, spread double, p10 double, p90 double, n bigint, name string, `group` string, `range` array<int>, n_primary bigint, n_secondary bigint, synonyms array<string>"
_SCORES = "struct<dims:map<string,double>,emo:map<string,double>,genu:double,blend:double>"
RECORD = f"id string, ei_gender double, global_scores {_SCORES}, sentences array<struct<text:string,start:double,`end`:double,scores:{_SCORES},bursts:array<string>>>"


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id, preds) of JSON documents, one object or an array of objects in each file; preds keeps the object's text."""
    return documents_of(spark.read.text(path, wholetext=True))


def documents_of(texts: DataFrame) -> DataFrame:
    """The same of texts (value) in a table."""
    raw = texts.select(F.trim("value").alias("t"))
    each = F.when(F.startswith("t", F.lit("[")), F.from_json("t", "array<string>")).otherwise(F.array("t"))
    return raw.select(F.explode(each).alias("preds")).select(F.get_json_object("preds", "$.id").alias("entity_id"), "preds")


def checked_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(archive, key, preds, error) of JSON documents: a file, or an object in an array, that is not JSON or has no id is a row with the reason."""
    return checked_of(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value"))


def checked_of(texts: DataFrame) -> DataFrame:
    """The same of texts (file, value) in a table, such as documents.texts_of."""
    raw = texts.select(F.col("file").alias("archive"), F.trim("value").alias("t"))
    each = F.when(F.startswith("t", F.lit("[")), F.from_json("t", "array<string>")).otherwise(F.array("t"))
    rows = raw.select("archive", F.explode_outer(F.coalesce(each, F.array(F.lit(None).cast("string")))).alias("preds"))
    key, ok = F.get_json_object("preds", "$.id"), F.try_parse_json("preds").isNotNull()
    error = F.when(~ok, "not JSON").when(key.isNull(), "no id")
    return rows.select("archive", F.when(ok, key).alias("key"), F.when(error.isNull(), F.col("preds")).alias("preds"), error.alias("error"))


def predictions_from_text(spark: SparkSession, text: str) -> DataFrame:
    """The same from text at hand, such as standard input: one object or an array of objects."""
    return documents_of(spark.createDataFrame([(text,)], "value string"))


def baseline_document(spark: SparkSession, path: str, groups: dict[str, str] | None = None) -> DataFrame:
    """Baseline rows from a JSON object dim -> statistics; the entry `_meta` has no group and stays out.

    groups: names of the file's groups -> trait, emotion, quality, if it has others.
    """
    doc = F.from_json("value", "map<string,string>")
    rows = spark.read.text(path, wholetext=True).select(F.explode(doc).alias("dim", "s")).select("dim", F.from_json("s", STAT).alias("s"))
    return rows.select("dim", *[F.col(f"s.{c}").alias("grp" if c == "group" else c) for c in rows.schema["s"].dataType.names]).filter("grp is not null").replace(groups or {"": ""}, subset=["grp"])


def baseline_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parquet_files(spark: SparkSession, folder: str, pattern: str, columns: Sequence[str], first: int | None = None) -> DataFrame:
    """Some columns of a folder's files that match a pattern; of the first files by name if a number is given."""
    df = spark.read.option("pathGlobFilter", pattern).parquet(folder)
    if first is not None:
        names = sorted(df.inputFiles())[:first]
        df = spark.read.parquet(*names) if names else df.limit(0)
    return df.select(*columns)


def _members(content: bytes, suffix: str, wanted: frozenset[str] | None) -> Iterator[tuple[str, bytes]]:
    """What can be read of an archive, up to the place where it is broken."""
    try:
        tar = tarfile.open(fileobj=io.BytesIO(content), mode="r|*")
    except (OSError, EOFError, tarfile.TarError):
        return
    with tar:
        while True:
            try:
                m = tar.next()
                if m is None:
                    return
                key = m.name[: -len(suffix)] if suffix else m.name
                if not m.isfile() or not m.name.endswith(suffix) or (wanted is not None and key not in wanted):
                    continue
                data = tar.extractfile(m).read()
            except (OSError, EOFError, tarfile.TarError):
                return
            yield key, data


def tar_members(spark: SparkSession, path: str, suffix: str, keys: Iterable[str] | None = None) -> DataFrame:
    """(archive, key, content) of members with a suffix, and of some keys only; archives and members that can't be read are left out.

    An archive meets a task whole, one at a time; its members leave the task one after another.  archives.tar_members reads archives in pieces and lists
    what can't be read; this one serves stores that only Spark's own readers know.
    """
    wanted = None if keys is None else frozenset(keys)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                for key, data in _members(content.as_py(), suffix, wanted):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([key]), pa.array([data], pa.binary())], names=["archive", "key", "content"])

    return files.mapInArrow(rows, "archive string, key string, content binary")


def decode_audio(files: DataFrame, key: str, content: str, rate: int = 16_000) -> DataFrame:
    """(key, samples, error): a file that can't be decoded gives its error and no samples, and does not stop the others."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch.column(key).to_pylist(), batch.column(content)):
                samples, error = None, None
                try:
                    samples = wav_samples(c.as_py(), rate)
                except Exception as e:  # any broken file is data here
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([samples], pa.list_(pa.float32())), pa.array([error], pa.string())], names=[key, "samples", "error"])

    return files.select(key, content).mapInArrow(rows, f"{key} {dict(files.dtypes)[key]}, samples array<float>, error string")


def files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length) of files that match a glob."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length")


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(class_ix, class, grp, description) in document order, no_burst last, from categories -> group -> items -> class -> {description}.

    Order comes from the positions of keys in the text, since maps promise none.
    """
    as_map, keys = (lambda c: F.from_json(c, "map<string,string>")), F.json_object_keys
    cats = spark.read.text(path, wholetext=True).select(F.get_json_object("value", "$.categories").alias("c"))
    groups = cats.select(as_map(F.col("c")).alias("m"), F.posexplode(keys("c")).alias("g_ix", "grp")).select("g_ix", "grp", F.get_json_object(F.col("m")[F.col("grp")], "$.items").alias("i"))
    rows = groups.select("g_ix", "grp", as_map(F.col("i")).alias("m"), F.posexplode(keys("i")).alias("i_ix", "class"))
    row = F.struct("g_ix", "i_ix", "class", "grp", F.get_json_object(F.col("m")[F.col("class")], "$.description").alias("description"))
    listed = rows.agg(F.array_sort(F.collect_list(row)).alias("l"))
    last = F.struct(F.lit(1 << 30).alias("g_ix"), F.lit(0).alias("i_ix"), F.lit("no_burst").alias("class"), F.lit(None).cast("string").alias("grp"), F.lit(None).cast("string").alias("description"))
    return listed.select(F.posexplode(F.concat("l", F.array(last))).alias("class_ix", "r")).select("class_ix", "r.class", "r.grp", "r.description")


def synonyms(spark: SparkSession, path: str) -> DataFrame:
    """(dim, synonyms) from {"categories": {name: {"keywords": [...]}}}."""
    cats = F.from_json(F.get_json_object("value", "$.categories"), "map<string,struct<keywords:array<string>>>")
    return spark.read.text(path, wholetext=True).select(F.explode(cats).alias("dim", "c")).select("dim", F.coalesce("c.keywords", F.array().cast("array<string>")).alias("synonyms"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Stored score records."""
    return spark.read.schema(RECORD).json(path, multiLine=True)


def records_of(texts: DataFrame) -> DataFrame:
    """The same of texts (value) in a table, one record or an array of records in each."""
    t, one = F.trim("value"), f"struct<{RECORD}>"
    return texts.select(F.inline(F.when(F.startswith(t, F.lit("[")), F.from_json(t, f"array<{one}>")).otherwise(F.array(F.from_json(t, one)))))
