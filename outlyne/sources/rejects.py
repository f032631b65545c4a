"""Good and bad rows of a source as two tables, written in one pass."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import shared_dir


def parted(df: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of rows with a column `error`: those where it is null, without it, and the others.

    Both are written by one pass over df, to `path` or a new folder of the shared one, and read again; the folder is the caller's if it is named.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/parted-{uuid.uuid4().hex[:12]}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.withColumn("_bad", F.col("error").isNotNull()).write.mode("overwrite").partitionBy("_bad").parquet(path)
    both = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, _bad boolean").parquet(path)
    return both.filter("not _bad").drop("_bad", "error"), both.filter("_bad").drop("_bad")
