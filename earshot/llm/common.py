"""What the operators of this package share: words, row wrapping, bounded block counts."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.sources import storage

# A word is a run of anything but these six characters.
BLANK, LETTER = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
# Rows of a lookup table that is broadcast after it was counted, if its bytes allow it too.
MAX_BROADCAST_ROWS = 200_000


def importable(spark: SparkSession) -> None:
    """Lets Python workers that have the driver's folders import this package from there; ``--py-files`` serves others."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", home)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a missing one counting as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for an empty or blank one."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK}+", -1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def wrapped(df: DataFrame, **columns: Column) -> DataFrame:
    """Named columns beside the whole input row in ``row``, so that none of its names can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unwrapped(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def at_most(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``rows`` rows, and not too many bytes."""
    return F.broadcast(df) if storage.is_small(df, rows) else df


# Rows of a batch that are held as Python objects at once.
SLICE_ROWS = 500


def sliced(batches, rows: int = SLICE_ROWS):
    """The rows of Arrow batches in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# Rows that one step of a running sum goes over.
SUM_BLOCK = 4096


def prefix_sums(df: DataFrame, group: list[str], at: str, value: str, name: str, block: int = SUM_BLOCK) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the group with a smaller ``at``.

    ``at`` is a whole number, not null and mostly without large gaps, one row per group and
    number. Runs of ``block`` numbers are summed first, the sums of those runs are added up
    in the same way, and only then the rows within each run: no task ever orders a whole
    group, however large.
    """
    placed = df.withColumn("_run", F.floor(F.col(at) / block).cast("long"))
    within = Window.partitionBy(*group, "_run").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    inner = placed.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    runs = placed.groupBy(*group, "_run").agg(F.sum(value).alias("_total"))
    upper = Window.partitionBy(*group, F.floor(F.col("_run") / block)).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_block", F.floor(F.col("_run") / block)).withColumn("_before", F.coalesce(F.sum("_total").over(upper), F.lit(0)))
    # Runs of runs: a 16-millionth of the rows.
    top = runs.groupBy(*group, "_block").agg(F.sum("_total").alias("_sum"))
    keys = [F.col(g) for g in group] or [F.lit(0)]
    order = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    top = top.withColumn("_above", F.coalesce(F.sum("_sum").over(order), F.lit(0))).drop("_sum")
    bases = runs.join(top, [*group, "_block"]).select(*group, "_run", (F.col("_before") + F.col("_above")).alias("_base"))
    return inner.join(bases, [*group, "_run"]).withColumn(name, F.col("_inner") + F.col("_base")).drop("_run", "_inner", "_base")
