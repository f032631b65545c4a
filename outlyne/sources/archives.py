"""Archives and arrays in files, read piece by piece: no task holds a file, and what can't be read is a row with the reason.

First the headers of each file are walked, by one task a file, which seeks from header to header and reads no contents.  That gives an index: members
with place and length, or runs of rows.  The index is then dealt out in pieces of so many bytes, and tasks read their pieces by seeking.  So one
large archive is many tasks' work.  A compressed file has no places to seek to: it is one piece, read as a stream.

Files are opened by the tasks themselves: see `files`.  For stores that only Spark's own readers know, scans.tar_members reads whole files.
"""

from __future__ import annotations

import struct
import tarfile
import zipfile
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

PIECE = 64 << 20
BATCH = 8 << 20  # bytes of contents sent at once
_TAR = "archive string, offset long, size long, key string, error string"
_NPZ = "archive string, first long, count long, error string"


def _reason(e: BaseException) -> str:
    return f"{type(e).__name__}: {e}"


def _of_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths and lengths, a few files a task; contents are not read.  Spark does not list empty files."""
    found = spark.read.format("binaryFile").load(pattern).select("path", "length")
    return found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")


def _dealt(index: DataFrame, *by: str) -> DataFrame:
    """The number of partitions is given, since the rows of an index are far smaller than what they stand for."""
    return index.repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _headers(path: str, length: int) -> Iterator[dict]:
    try:
        with files.opened(path) as f:
            if f.read(2) == b"\x1f\x8b":
                yield {"archive": path, "offset": -1, "size": length}
                return
            f.seek(0)
            with tarfile.open(fileobj=f, mode="r:") as tar:
                while (m := tar.next()) is not None:
                    tar.members = []  # else all headers are kept
                    if m.isfile():
                        cut = m.offset_data + m.size > length
                        yield {"archive": path, "offset": m.offset_data, "size": m.size, "key": m.name, "error": "member is cut off" if cut else "sparse member" if m.issparse() else None}
    except (OSError, EOFError, tarfile.TarError) as e:
        yield {"archive": path, "error": _reason(e)}


def tar_index(spark: SparkSession, pattern: str) -> DataFrame:
    """(archive, offset, size, key, error) of the members of archives, in which key is a member's name.

    A compressed archive is one row without key, at offset -1.  A broken header ends an archive: what was before it stays, and a row has the reason.
    """
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("key", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[dict] = []
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                for row in _headers(path, length):
                    held.append(row)
                    if len(held) >= 10_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema)

    return _of_files(spark, pattern).mapInArrow(run, _TAR)


def _streamed(path: str) -> Iterator[tuple[str | None, bytes | None, str | None]]:
    try:
        with files.opened(path) as f, tarfile.open(fileobj=f, mode="r|*") as tar:
            while (m := tar.next()) is not None:
                tar.members = []
                if m.isfile():
                    yield m.name, tar.extractfile(m).read(), None
    except Exception as e:  # zlib's errors have no common base
        yield None, None, _reason(e)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("archive", pa.string()), ("key", pa.string()), ("content", pa.large_binary()), ("error", pa.string())])
    held: list[dict] = []
    size, now, f = 0, None, None

    def sent() -> pa.RecordBatch:
        nonlocal size
        batch = pa.RecordBatch.from_pylist(held, schema)
        batch = batch.set_column(2, "content", batch.column(2).cast(pa.binary()))
        held.clear()
        size = 0
        return batch

    for batch in batches:
        for path, offset, length, key, error in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "size", "key", "error"))):
            rows: Iterator[tuple] = iter([(key, None, error)])
            if error is None and offset < 0:
                rows = _streamed(path)
            elif error is None:
                try:
                    if path != now:
                        f, now = files.opened(path), path
                    f.seek(offset)
                    data = f.read(length)
                    rows = iter([(key, data, None) if len(data) == length else (key, None, "member is cut off")])
                except OSError as e:
                    rows = iter([(key, None, _reason(e))])
            for k, data, why in rows:
                held.append({"archive": path, "key": k, "content": data, "error": why})
                size += len(data or b"")
                if size >= BATCH or len(held) >= 10_000:
                    yield sent()
    if held:
        yield sent()


def tar_members(spark: SparkSession, pattern: str, suffix: str = "", keys: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """(archive, key, content, error) of members whose name ends in suffix; key is the name without it.

    keys: (key) of those to be read; others are not.  Rows with an error have no content: a member that can't be read, or the rest of an archive (key null).
    """
    index = tar_index(spark, pattern)
    strip = lambda c: F.substring(c, F.lit(1), F.length(c) - len(suffix)) if suffix else c
    named = index.filter(F.col("key").isNull() | F.endswith("key", F.lit(suffix))).withColumn("key", strip(F.col("key")))
    if keys is not None:
        named = named.filter("key is null").unionByName(named.join(keys.select("key").distinct(), "key", "left_semi"))
    at = named.withColumn("_piece", F.floor(F.coalesce("offset", F.lit(0)) / piece))
    read = _dealt(at, "archive", "_piece").sortWithinPartitions("archive", "offset").select("archive", "offset", "size", "key", "error")
    out = read.mapInArrow(_contents, "archive string, key string, content binary, error string")
    # members of compressed archives are only known now
    late = F.element_at(F.split("archive", r"\."), -1).isin("gz", "tgz")
    if suffix:
        out = out.filter(~late | F.col("key").isNull() | F.endswith("key", F.lit(suffix))).withColumn("key", F.when(late, strip(F.col("key"))).otherwise(F.col("key")))
    if keys is not None:
        out = out.filter(~late | F.col("key").isNull()).unionByName(out.filter(late).join(keys.select("key").distinct(), "key", "left_semi").select(*out.columns))
    return out


class _Array:
    """One array of an .npz file, a run of rows at a time.  A stored member is read by seeking in the file, a compressed one as a stream."""

    def __init__(self, f: Any, z: zipfile.ZipFile, name: str):
        info = z.getinfo(name)
        self.stored = info.compress_type == zipfile.ZIP_STORED
        self.f, begin = (f, 0) if self.stored else (z.open(name), 0)
        if self.stored:
            f.seek(info.header_offset + 26)
            begin = info.header_offset + 30 + sum(struct.unpack("<HH", f.read(4)))  # after the member's own name and extra field
            f.seek(begin)
        version = np.lib.format.read_magic(self.f)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        self.shape, fortran, self.dtype = read(self.f)
        if fortran and len(self.shape) > 1 or self.dtype.hasobject:
            raise ValueError(f"{name} holds objects or columns")
        self.start = self.f.tell()
        self.row = self.dtype.itemsize * int(np.prod(self.shape[1:]))
        if self.stored and self.start + self.shape[0] * self.row > begin + info.file_size:
            raise EOFError("array is cut off")

    def rows(self, first: int, count: int) -> np.ndarray:
        self.f.seek(self.start + first * self.row)  # in a stream, forward: what lies between is read over
        data = self.f.read(count * self.row)
        if len(data) < count * self.row:
            raise EOFError("array is cut off")
        return np.frombuffer(data, self.dtype).reshape(count, *self.shape[1:])


def _arrays(f: Any, ids: str, values: str) -> tuple[_Array, _Array]:
    z = zipfile.ZipFile(f)
    a, b = _Array(f, z, f"{ids}.npy"), _Array(f, z, f"{values}.npy")
    if not a.shape or len(b.shape) != 2 or a.shape[0] != b.shape[0]:
        raise ValueError(f"shapes {a.shape} and {b.shape}")
    return a, b


def npz_rows(spark: SparkSession, pattern: str, ids: str = "ids", values: str = "emb", piece: int = PIECE) -> DataFrame:
    """(archive, id, embedding, error) of .npz files with an array of ids and one of as many rows.

    Rows with an error stand for a file, or a run of rows, that can't be read.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("first", pa.int64()), ("count", pa.int64()), ("error", pa.string())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                try:
                    with files.opened(path) as f:
                        a, b = _arrays(f, ids, values)
                        n = b.shape[0]
                        step = max(1, piece // max(1, a.row + b.row))
                        step = step if a.stored and b.stored else max(n, 1)
                    out = [{"archive": path, "first": i, "count": min(step, n - i)} for i in range(0, n, step)]
                except Exception as e:  # whatever a broken file raises is its reason
                    out = [{"archive": path, "error": _reason(e)}]
                yield pa.RecordBatch.from_pylist(out, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "id", "embedding", "error"]
        failed = lambda path, why: pa.RecordBatch.from_arrays([pa.array([path]), pa.array([None], pa.string()), pa.array([None], pa.list_(pa.float32())), pa.array([why])], names=names)
        for batch in batches:
            for path, first, count, error in zip(*(batch.column(c).to_pylist() for c in ("archive", "first", "count", "error"))):
                if error is not None:
                    yield failed(path, error)
                    continue
                try:
                    with files.opened(path) as f:
                        a, b = _arrays(f, ids, values)
                        step = max(1, BATCH // max(1, 4 * b.shape[1]))
                        for i in range(first, first + count, step):
                            n = min(step, first + count - i)
                            id_, x = a.rows(i, n), b.rows(i, n).astype(np.float32)
                            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * b.shape[1], pa.array(x.reshape(-1)))
                            yield pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([str(k) for k in id_.tolist()]), lists, pa.nulls(n, pa.string())], names=names)
                except Exception as e:
                    yield failed(path, _reason(e))

    index = _of_files(spark, pattern).mapInArrow(plan, _NPZ)
    return _dealt(index, "archive", "first").mapInArrow(read, "archive string, id string, embedding array<float>, error string")


def remove(spark: SparkSession, pattern: str) -> int:
    """Deletes the files of a pattern, by the tasks; for archives whose contents have been written and committed.  Returns how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files.removed(path)  # a repeated task finds the file gone
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return _of_files(spark, pattern).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
