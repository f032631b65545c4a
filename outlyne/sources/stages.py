"""Stage tables in the folder that all executors share: what several parts of a plan read is computed once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import stage

BYTES = 64 << 20  # of texts and lists in a table that is broadcast

_local_dirs: dict[str, str] = {}
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a local master without the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_dirs.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="outlyne-"))


def _path(spark: SparkSession, uri: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Stage tables made inside are removed at the end, after an error too.  Results that read them must have been written or collected by then."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        yield
    finally:
        _made.reset(outer)
        for uri in made:
            store, at = _path(spark, uri)
            store.delete(at, True)


def once(df: DataFrame, name: str) -> DataFrame:
    """df, written to a new folder and read back: its lineage ends here.  The folder goes with its owner, or else when the JVM ends."""
    spark = df.sparkSession
    uri = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    made = _made.get()
    if made is None:
        store, at = _path(spark, uri)
        store.deleteOnExit(at)
    else:
        made.append(uri)
    return stage(df, uri)


def small(df: DataFrame, rows: int = 100_000, size: int = BYTES) -> DataFrame:
    """A stored table with a broadcast hint if it has no more rows than that, and no more bytes of texts, lists and maps; else Spark joins by shuffle."""
    long = [c for c, t in df.dtypes if t in ("string", "binary") or t.startswith(("array", "map", "struct"))]
    held = F.sum(F.octet_length(F.to_json(F.struct(*long)))) if long else F.lit(0)
    n, b = df.agg(F.count("*"), F.coalesce(held, F.lit(0))).first()
    return F.broadcast(df) if n <= rows and b <= size else df
