"""Shared plumbing: input tables, stage tables in the folder all executors share, Arrow batch size."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text: maximal runs of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_local_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(c, _UPPER, _LOWER)


def id_crc(c: Column) -> Column:
    """crc32 of the decimal text of an id."""
    return F.crc32(c.cast("string").cast("binary"))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a local master without the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_dirs.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="outlyne-"))


class Workspace:
    """A folder of stage tables below the shared folder.

    put() writes a DataFrame as Parquet and returns the reread table, which cuts the lineage: a lost executor
    costs a reread and not a recomputation.  drop() removes a stage that is no longer needed; what is left is
    removed when the JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))
        self._fs.deleteOnExit(self._path(self.root))

    def put(self, name: str, df: DataFrame, narrow: bool = False) -> DataFrame:
        """narrow: rows that are much smaller than what they were made from.  They are dealt over fewer files than there were tasks, an
        eighth of the shuffle partitions, since each file costs its creation and a later task."""
        if narrow:
            df = df.repartition(max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8))
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def keep(self, *names: str) -> None:
        """Removes all other stages."""
        self.drop(*(n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))) if n not in names))

    def drop(self, *names: str) -> None:
        for n in names:
            self._fs.delete(self._path(f"{self.root}/{n}"), True)


def numbered(ws: Workspace, docs: DataFrame, row: str | None = None) -> tuple[DataFrame, bool]:
    """docs with a column `row` of unique integers, and whether that is just doc_id.

    Ids that are unique and not null number the rows; else rows get numbers in a stored table.  row: a column that has such numbers already.
    """
    if row:
        return docs.withColumnRenamed(row, "row"), False
    if docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").isEmpty():
        return docs.withColumn("row", F.col("doc_id")), True
    return ws.put("rows", docs.withColumn("row", F.monotonically_increasing_id())), False


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int = 500):
    """Rows of an Arrow batch sent to Python while the block runs: whole texts are long, so batches are short."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int, limit_mb: int = 48) -> DataFrame:
    """A broadcast hint if rows * row_bytes is below the limit; else Spark joins by shuffle."""
    return F.broadcast(df) if rows * row_bytes <= limit_mb << 20 else df
