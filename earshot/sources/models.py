"""Saved models."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save(model: ALSModel, path: str, overwrite: bool = False) -> str:
    """Write metadata and both factor tables; fails on an existing path unless told to overwrite."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return path


def load(path: str) -> ALSModel:
    return ALSModel.load(path)


def describe(model: ALSModel) -> DataFrame:
    """One row: ``rank``, ``users``, ``items``."""
    tables = model.userFactors.select(F.lit(1).alias("_u"), F.lit(0).alias("_i")).unionAll(
        model.itemFactors.select(F.lit(0).alias("_u"), F.lit(1).alias("_i"))
    )
    return tables.agg(
        F.lit(model.rank).alias("rank"),
        F.coalesce(F.sum("_u"), F.lit(0)).alias("users"),
        F.coalesce(F.sum("_i"), F.lit(0)).alias("items"),
    )
