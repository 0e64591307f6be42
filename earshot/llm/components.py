"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.sources import storage


def _toward(pairs: DataFrame, smallest: DataFrame) -> DataFrame:
    return pairs.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return _toward(both.filter("v > u"), smallest).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them. Links have u > v."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    return _toward(links, smallest).filter("u <> v").unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def roots(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``u`` and the smallest node of its component, ``v``, for every node that is not itself the smallest.

    ``links`` has ``u`` and ``v`` of one ordered type, no nulls; direction and repetition do
    not matter. Each round is a few joins and a table in the shared folder, and halves the
    depth at least; the links become stars and then stay.
    """
    # The smaller end second; self links say nothing.
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    links, before = storage.written(links, "links"), None
    for _ in range(rounds):
        # Enough to see that nothing moved: the number of links and a sum over their hashes.
        sums = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        state = (sums[0], sums[1])
        if state == before or not sums[0]:
            return links
        before = state
        links = storage.written(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"links did not settle within {rounds} rounds")
