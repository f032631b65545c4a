"""One ordered document, or one file for each row, written by all tasks.

Rows are sorted by range, each task writes its part to a file of its own, and tells how many rows and bytes it has.  When all are
done the parts are joined in order between head and tail; counts come from what the tasks told.  Parts of failed attempts are left out and removed.

Documents of rows have a row on each line, so they are read in pieces of bytes by all tasks: the rows of each piece are counted, and a row's place in
the document is its place in the piece after the rows of the pieces before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from . import files, stages

CHUNK = 8 << 20
PIECE = 64 << 20
FOLDERS = 4096


@dataclass
class Part(WriterCommitMessage):
    """What a task tells of its part."""

    number: int
    rows: int
    size: int
    path: str


class _PartWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.between = options["path"], options.get("between", ", ")
        self.head, self.tail = options.get("head", ""), options.get("tail", "")
        self.parts = f"{self.path}.parts-{options['run']}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        task = TaskContext.get()
        part = Part(task.partitionId(), 0, 0, f"{self.parts}/{task.partitionId()}-{task.taskAttemptId()}")
        out = None
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                texts = batch.column(0).slice(i, 500).to_pylist()
                data = ((self.between if part.rows else "") + self.between.join(texts)).encode()
                out = out or files.created(part.path)
                out.write(data)
                part.rows, part.size = part.rows + len(texts), part.size + len(data)
        if out:
            out.close()
        return part

    def commit(self, messages: list) -> None:
        parts = sorted((m for m in messages if m and m.rows), key=lambda m: m.number)
        total = sum(m.rows for m in parts)
        with files.created(self.path) as out:
            out.write(self.head.replace("{n}", str(total)).encode())
            for i, m in enumerate(parts):
                out.write(self.between.encode() if i else b"")
                with files.opened(m.path) as f:
                    got = 0
                    while data := f.read(CHUNK):
                        out.write(data)
                        got += len(data)
                if got != m.size:
                    raise OSError(f"{m.path} has {got} bytes, not {m.size}")
            out.write(self.tail.encode())
        with files.created(f"{self.path}.count") as out:
            out.write(json.dumps({"n": total, "parts": len(parts)}).encode())
        files.removed(self.parts)

    def abort(self, messages: list) -> None:
        files.removed(self.parts)


class _RowWriter(DataSourceArrowWriter):
    """(name, value): a file for each row."""

    def __init__(self, options: dict[str, str]):
        self.path, self.suffix = options["path"], options.get("suffix", ".json")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        task, n, size, made = TaskContext.get(), 0, 0, set()
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with files.created(f"{self.path}/{name}{self.suffix}", made) as out:
                    out.write(value.encode())
                n, size = n + 1, size + len(value)
        return Part(task.partitionId(), n, size, "")

    def commit(self, messages: list) -> None:
        with files.created(f"{self.path}.count") as out:
            out.write(json.dumps({"n": sum(m.rows for m in messages if m)}).encode())


class DocumentSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "outlyne_document"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return (_RowWriter if self.options.get("each") == "row" else _PartWriter)(dict(self.options))


def _saved(df: DataFrame, path: str, **options: str) -> int:
    df.sparkSession.dataSource.register(DocumentSink)
    df.write.format(DocumentSink.name()).mode("append").options(path=path, run=uuid.uuid4().hex[:12], **options).save()
    with files.opened(f"{path}.count") as f:
        n = json.loads(f.read())["n"]
    files.removed(f"{path}.count")
    return n


def ordered(df: DataFrame, path: str, value: Column, order: list[str], head: str = "", tail: str = "", between: str = ", ") -> int:
    """Writes the texts `value` of all rows in order as one file; `{n}` in head is their number, which is returned.  A null text is left out."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_value", value).filter("_value is not null").repartitionByRange(n, *order).sortWithinPartitions(*order)
    return _saved(rows.select(F.col("_value").alias("value")), path, head=head, tail=tail, between=between)


def _objects(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def results(df: DataFrame, path: str, order: list[str]) -> int:
    """{"n": ..., "results": [...]} of all rows, in order, each on a line of its own."""
    return ordered(df, path, _objects(df), order, '{"n": {n}, "results": [\n', "\n]}", ",\n")


def combined(df: DataFrame, path: str, order: list[str]) -> int:
    """A JSON array of all rows, in order, each on a line of its own."""
    return ordered(df, path, _objects(df), order, "[\n", "\n]", ",\n")


def _lines(path: str, lo: int, hi: int) -> Iterator[list[bytes]]:
    """The lines that begin at a byte from lo up to hi, a few megabytes at a time."""
    with files.opened(path) as f:
        at, held, inside = max(lo - 1, 0), b"", lo > 0
        f.seek(at)
        while data := f.read(CHUNK):
            held += data
            if inside:  # the line that began in the piece before
                first = held.find(b"\n")
                at, held = (at + len(held), b"") if first < 0 else (at + first + 1, held[first + 1 :])
                inside = first < 0
                if at >= hi:
                    return
                if inside:
                    continue
            end = held.find(b"\n", max(hi - 1 - at, 0))
            last = end if end >= 0 else held.rfind(b"\n")
            if last >= 0:
                yield held[:last].split(b"\n")
                at, held = at + last + 1, held[last + 1 :]
            if end >= 0:
                return
        if held:
            yield [held]


def _rows(path: str, lo: int, hi: int) -> Iterator[tuple[bytes | None, list[bytes]]]:
    """(head, rows) of a piece; the head comes first, in the first piece only."""
    first, ended = lo == 0, False
    for lines in _lines(path, lo, hi):
        head = None
        if first:
            head, lines, first = lines[0], lines[1:], False
            if not head.endswith(b"["):
                raise ValueError(f"{path}: the rows do not begin on a line of their own")
            yield head, []
        rows = []
        for line in lines:
            ended = ended or line.startswith(b"]")
            if line and not ended:
                if not (line.startswith(b"{") and line.endswith((b"}", b"},"))):
                    raise ValueError(f"{path}: a line is not a row: {line[:80]!r}")
                rows.append(line.removesuffix(b","))
        yield None, rows


def rows(spark: SparkSession, path: str, schema: str, piece: int = PIECE) -> DataFrame:
    """(path, head, pos, r) of documents that `results` and `combined` have written: r is a row, pos its place from 0, head what precedes the rows.

    A document in another layout, such as one on a single line, is an error; Spark's own readers read those, by one task each.  Tasks open the files
    themselves: see `files`.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.read.format("binaryFile").load(path).select("path", "length")
    pieces = found.select("path", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(piece))).alias("lo")).repartition(n, "path", "lo")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at, lo in zip(batch.column("path").to_pylist(), batch.column("lo").to_pylist()):
                got = {"path": at, "lo": lo, "n": 0, "head": None}
                for head, some in _rows(at, lo, lo + piece):
                    got["n"] += len(some)
                    got["head"] = got["head"] if head is None else head.decode()
                out.append(got)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("lo", pa.int64()), ("n", pa.int64()), ("head", pa.string())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, lo, pos, head in zip(*(batch.column(c).to_pylist() for c in ("path", "lo", "pos", "head"))):
                for _, some in _rows(at, lo, lo + piece):
                    for i in range(0, len(some), 10_000):
                        part = some[i : i + 10_000]
                        cells = [pa.array([at] * len(part)), pa.array([head] * len(part), pa.string()), pa.array(range(pos, pos + len(part)), pa.int64()), pa.array(part, pa.binary()).cast(pa.string())]
                        pos += len(part)
                        yield pa.RecordBatch.from_arrays(cells, names=["path", "head", "pos", "value"])

    sizes = stages.once(pieces.mapInArrow(counted, "path string, lo long, n long, head string"), "pieces")
    line = Window.partitionBy("path").orderBy("lo")
    before = F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    dealt = sizes.select("path", "lo", before.alias("pos"), F.first("head").over(line).alias("head")).repartition(n, "path", "lo")
    lines = dealt.mapInArrow(read, "path string, head string, pos long, value string")
    return lines.select("path", "head", "pos", F.from_json("value", schema).alias("r"))


def results_rows(spark: SparkSession, path: str, schema: str, piece: int = PIECE) -> DataFrame:
    """(n, pos, r) of a document that `results` has written; n is the number that it states."""
    return rows(spark, path, schema, piece).select(F.get_json_object(F.concat("head", F.lit("]}")), "$.n").cast("long").alias("n"), "pos", "r")


def baseline(stats: DataFrame, path: str, meta: dict) -> int:
    """A JSON object with `_meta` first and the dimensions in code-point order."""
    name = F.regexp_replace(F.to_json(F.struct(F.col("dim").alias("k"))), r'^\{"k":((?s).*)\}$', "$1")
    body = F.to_json(F.struct(*[F.col(c).alias("group" if c == "grp" else c) for c in stats.columns if c != "dim"]))
    return ordered(stats, path, F.concat(F.lit(",\n"), name, F.lit(": "), body), ["dim"], f'{{"_meta": {json.dumps(meta)}', "}", "")


def texts_each(df: DataFrame, path: str, name: Column, value: Column, suffix: str = ".json", folders: int = 0) -> int:
    """A file for each row, named by a column; rows of one name leave one file.  folders: so many inner folders take the files, by hash of the name,
    so that very many files can be listed by many tasks."""
    name = name.cast("string")
    placed = F.concat_ws("/", F.pmod(F.xxhash64(name), F.lit(folders)).cast("string"), name) if folders else name
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _saved(df.select(placed.alias("name"), value.alias("value")).repartition(n, "name"), path, each="row", suffix=suffix)


def one_file_each(df: DataFrame, path: str, name: str, folders: int = 0) -> int:
    """The same with the row itself as JSON."""
    return texts_each(df, path, F.col(name), _objects(df), folders=folders)


def texts_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): the texts of all files in a folder and its inner ones, whole; hidden and empty files are left out, as by Spark.

    One task lists the folder, all tasks list and read its inner folders, one file at a time: neither the driver nor a task holds the names of all files
    if they are in inner folders.  Tasks open the files themselves: see `files`.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = list(files.entries(path, False))
                yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([d for _, d in found], pa.bool_())], names=["at", "folder"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        texts: list[bytes] = []
        size = 0

        def sent() -> pa.RecordBatch:
            nonlocal size
            batch = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], names=["file", "value"])
            names.clear()
            texts.clear()
            size = 0
            return batch

        for batch in batches:
            for at, folder in zip(batch.column("at").to_pylist(), batch.column("folder").to_pylist()):
                for file in (f for f, _ in files.entries(at, True)) if folder else (at,):
                    names.append(file)
                    texts.append(files.content(file))
                    size += len(texts[-1])
                    if size >= CHUNK or len(names) >= 10_000:
                        yield sent()
        if names:
            yield sent()

    top = spark.range(0, 1, 1, 1).mapInArrow(listed, "at string, folder boolean").repartition(n, "at")
    return top.mapInArrow(read, "file string, value binary").select("file", F.col("value").cast("string").alias("value"))
