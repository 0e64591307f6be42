"""The shared folder of the session, and tables written there."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    ``spark.checkpoint.dir`` decides. Only a local session without it gets a
    temporary folder; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
            configured = tempfile.mkdtemp(prefix="earshot-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to, below the checkpoint folder; removed when the session's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by column, safe from lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    # The schema is known: no job to find it, and partition columns keep their type.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, *sort_by: str) -> DataFrame:
    """``df`` as a table in the shared folder, in ``buckets`` files by ``key``, each sorted by it and by ``sort_by``.

    What groups, joins or ranks by ``key`` reads it without a shuffle. The table is in the
    session's catalog under a name of its own. All rows of a key are in one file, and one
    task reads it: see that no key is too large.
    """
    spark = df.sparkSession
    path, table = fresh_path(spark, name), f"earshot_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, key).sortWithinPartitions(key, *sort_by)
    rows.write.option("path", path).bucketBy(buckets, key).sortBy(key, *sort_by).format("parquet").saveAsTable(table)
    return spark.table(table)


# Bytes of a table that is broadcast after it was measured.
MAX_BROADCAST_BYTES = 64 << 20
_ROW_BYTES, _VALUE_BYTES = 32, 8


def is_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most so many rows, and bytes in memory: texts by their length, other values 8 each. Runs a job."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    per_row = sum(texts, F.lit(_ROW_BYTES + _VALUE_BYTES * len(df.columns)))
    n, size = df.agg(F.count("*"), F.sum(per_row.cast("long"))).head()
    return n <= max_rows and (size or 0) <= max_bytes
