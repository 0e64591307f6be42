"""Readers for the interaction table and its two optional dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.sources import schemas


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None) -> DataFrame:
    """Columns by name, typed by ``schema``; a cell that does not parse becomes NULL.

    A CSV is opened with its header only: no inference pass over the data, and
    the parser materialises just the selected columns. A whole number may be written as
    a decimal, 3.0 for 3. :func:`unreadable_cells` counts what does not parse.
    """
    raw = _raw(spark, path, schema, fmt)
    return raw.select(*[_typed(raw, f).alias(f.name) for f in schema])


def _opened(spark: SparkSession, path: str, fmt: str | None) -> DataFrame:
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    return spark.read.csv(path, header=True) if fmt == "csv" else spark.read.format(fmt).load(path)


def _raw(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None) -> DataFrame:
    raw = _opened(spark, path, fmt)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return raw


def _typed(raw: DataFrame, field: T.StructField) -> Column:
    given, value = raw.schema[field.name].dataType, raw[field.name]
    if given == field.dataType:
        return value
    if isinstance(field.dataType, T.IntegralType) and not isinstance(given, T.IntegralType):
        exact = value.try_cast("decimal(38,9)")
        whole = F.when(exact == F.floor(exact), exact).try_cast(field.dataType)
        return whole if not isinstance(given, T.StringType) else F.coalesce(value.try_cast(field.dataType), whole)
    return value.try_cast(field.dataType)


def unreadable_cells(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None) -> DataFrame:
    """One row: per column, the cells that hold something and do not parse."""
    raw = _raw(spark, path, schema, fmt)
    return raw.agg(*[
        F.count_if((F.trim(raw[f.name].cast("string")) != "") & _typed(raw, f).isNull()).alias(f.name) for f in schema
    ])


def read_interactions(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """``user_id``, ``song_id``, ``play_count`` from CSV (with header) or Parquet."""
    return _read(spark, path, schemas.INTERACTIONS, fmt)


def read_dimension(
    spark: SparkSession, path: str | None, schema: T.StructType, fmt: str | None = None
) -> DataFrame | None:
    """A user or song dimension; ``None`` when there is no path or nothing is there."""
    if path is None or not path_exists(spark, path):
        return None
    return _read(spark, path, schema, fmt)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file system Spark knows holds ``path``; reads no data."""
    try:
        spark.read.text(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def validate_inputs(
    spark: SparkSession,
    required: Mapping[str, str],
    optional: Mapping[str, str | None] | None = None,
) -> dict[str, bool]:
    """Presence by name; a missing required input raises ``FileNotFoundError``."""
    present = {name: path_exists(spark, path) for name, path in required.items()}
    absent = [f"{name} ({required[name]})" for name, there in present.items() if not there]
    if absent:
        raise FileNotFoundError("missing input: " + ", ".join(absent))
    for name, path in (optional or {}).items():
        present[name] = path is not None and path_exists(spark, path)
    return present


def input_report(
    spark: SparkSession,
    required: Mapping[str, str],
    optional: Mapping[str, str | None] | None = None,
    fmt: str | None = None,
) -> DataFrame:
    """Per input ``name``, ``required``, ``present`` and ``n_rows``, NULL where nothing is there; one count a table.

    A missing required input is a row here, not an error, so that one look shows all that is missing.
    A CSV's header is no row.
    """
    rows = []
    for needed, inputs in ((True, required), (False, optional or {})):
        for name, path in inputs.items():
            there = path is not None and path_exists(spark, path)
            head = [F.lit(name).alias("name"), F.lit(needed).alias("required"), F.lit(there).alias("present")]
            if there:
                rows.append(_opened(spark, path, fmt).agg(F.count("*").alias("n_rows")).select(*head, "n_rows"))
            else:
                rows.append(spark.range(1).select(*head, F.lit(None).cast("long").alias("n_rows")))
    if not rows:
        return spark.createDataFrame([], "name string, required boolean, present boolean, n_rows long")
    return reduce(DataFrame.unionByName, rows)


def user_ids(df: DataFrame, user: str = "user_id") -> DataFrame:
    """The known users: distinct, partially aggregated before the shuffle."""
    return df.select(user).filter(F.col(user).isNotNull()).distinct()
