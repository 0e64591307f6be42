"""Declared schemas and the checks that run before training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("song_id", T.LongType()),
        T.StructField("play_count", T.IntegerType()),
    ]
)
USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("Username", T.StringType()),
    ]
)
SONGS = T.StructType(
    [
        T.StructField("song_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("artist_name", T.StringType()),
    ]
)

# The trainer keeps ids as 32-bit integers.
MIN_ID, MAX_ID = -(2**31), 2**31 - 1


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _unusable_id(name: str) -> Column:
    value = F.col(name)
    return (value < MIN_ID) | (value > MAX_ID) | (value != F.floor(value))


def interaction_faults(
    df: DataFrame, user: str = "user_id", item: str = "song_id", plays: str = "play_count"
) -> DataFrame:
    """One row: how many rows break each rule of the interaction table."""
    return df.agg(
        F.count("*").alias("rows"),
        _count_if(F.col(user).isNull() | F.col(item).isNull()).alias("null_ids"),
        _count_if(_unusable_id(user) | _unusable_id(item)).alias("unusable_ids"),
        _count_if(F.col(plays).isNull()).alias("null_plays"),
        _count_if(F.col(plays) < 0).alias("negative_plays"),
    )


def require_valid_interactions(
    df: DataFrame, user: str = "user_id", item: str = "song_id", plays: str = "play_count"
) -> int:
    """Raise ``ValueError`` naming every broken rule; return the row count."""
    return _require(interaction_faults(df, user, item, plays), "interactions")


def require_trainable(df: DataFrame, user: str, item: str, rating: str) -> int:
    """Check ids and ratings in one aggregate; return the row count."""
    for name in (user, item):
        if not isinstance(df.schema[name].dataType, T.NumericType):
            raise ValueError(f"column {name} must be numeric, is {df.schema[name].dataType.simpleString()}")
    value = F.col(rating).cast("double")
    faults = df.agg(
        F.count("*").alias("rows"),
        _count_if(F.col(user).isNull() | F.col(item).isNull()).alias("null_ids"),
        _count_if(_unusable_id(user) | _unusable_id(item)).alias("unusable_ids"),
        _count_if(value.isNull() | F.isnan(value)).alias("null_ratings"),
        _count_if(value < 0).alias("negative_ratings"),
    )
    return _require(faults, "ratings")


def _require(faults: DataFrame, what: str) -> int:
    found = faults.head().asDict()
    rows = found.pop("rows")
    broken = {name: n for name, n in found.items() if n}
    if broken:
        detail = ", ".join(f"{name}={n}" for name, n in broken.items())
        raise ValueError(f"{what} cannot be used ({rows} rows): {detail}")
    return rows


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Raise ``ValueError`` when ``key`` repeats; return ``df`` unchanged."""
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").head(1)
    if repeated:
        raise ValueError(f"{key}={repeated[0][key]} appears {repeated[0]['count']} times")
    return df


def _gaps(names: list[str]) -> Column:
    """How many of the columns are missing or empty texts."""
    empty = [F.coalesce(F.col(c).cast("string") == "", F.lit(True)).cast("int") for c in names]
    return sum(empty[1:], empty[0])


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, so lookups never multiply rows: the one with fewest gaps, then the smallest by the other columns."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.select(key).distinct()
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(_gaps(rest).alias("_gaps"), *rest)).alias("_row"))
        .select(key, *[F.col("_row")[c].alias(c) for c in rest])
    )
