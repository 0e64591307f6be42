"""Where results go: files in a format of Spark's, or printed rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "orc", "json", "csv")
# In CSV a missing value is \N, so that it differs from an empty text; blanks and line breaks of texts stay.
_CSV = {"header": True, "nullValue": "\\N", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_WRITE = {"csv": _CSV, "json": {"ignoreNullFields": False}}
_READ = {"csv": {**_CSV, "multiLine": True}}
_NESTED = ("array", "map", "struct", "binary", "variant")


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: list[str] | None = None) -> str:
    r"""All rows of ``df`` below ``path``, as they lie; returns the path.

    CSV holds plain values only: a nested column is an error before anything is written, and a
    text of the two characters \N comes back as missing. Texts may have line breaks, so a CSV
    file is read by one task; the other formats are split. An existing path is an error unless ``mode`` says otherwise. An empty table gives a table
    without rows that :func:`read` can read.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, is {fmt!r}")
    if fmt == "csv":
        nested = [name for name, kind in df.dtypes if kind.startswith(_NESTED)]
        if nested:
            raise ValueError(f"csv cannot hold the columns {nested}")
    df.write.mode(mode).partitionBy(*(partition_by or [])).format(fmt).options(**_WRITE.get(fmt, {})).save(path)
    return path


def read(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """What :func:`write` has written, with the columns and kinds of ``like``; no job to find them."""
    read = spark.read.schema(like.schema).format(fmt).options(**_READ.get(fmt, {}))
    return read.load(path).select(*[F.col(f"`{c}`") for c in like.columns])


def printed(df: DataFrame, order: list[str | Column] | None = None) -> Iterator[str]:
    """A header and all rows, values with tabs between; the driver holds two partitions at a time."""
    yield "\t".join(df.columns)
    rows = df.orderBy(*order) if order else df
    for row in rows.toLocalIterator(prefetchPartitions=True):
        yield "\t".join("" if value is None else str(value) for value in row)
