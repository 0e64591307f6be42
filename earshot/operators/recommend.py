"""Top items per user from the factors."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators import best_items, factorize


def top_items(model: ALSModel, k: int = 10, users: DataFrame | None = None, exclude_seen: DataFrame | None = None) -> DataFrame:
    """``user_id``, ``recommendations`` array<struct<song_id, rating>>, best first.

    Songs the user already played stay in unless ``exclude_seen``, a table of ``user_id``
    and ``song_id``, names them; a user who has fewer than ``k`` others gets those, and one
    who has none an empty list. ``users`` limits the work to the requested ids. Searches
    when called, as :func:`best_items.search` does: what ``model.recommendForAllUsers`` gives, up to
    the rounding of a score and the order of equal ones, without computing every product.
    """
    own = users.select(F.col(model.getUserCol()).alias("user_id")) if users is not None and exclude_seen is None else users
    found = best_items.search(factorize.user_vectors(model), factorize.item_vectors(model), k, own, exclude_seen)
    if exclude_seen is not None:
        return listed(found.best, found.asked)
    # As the trainer's own lists: in the model's names, and no list without an item.
    lists = listed(found.best, found.asked, model.getUserCol(), model.getItemCol())
    return lists.filter(F.size("recommendations") > 0)


def listed(best: DataFrame, users: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """Rows of :func:`best_items.search` in the form of :func:`top_items`: one row per ``id`` of ``users``."""
    lists = best.groupBy(F.col("user_id").alias("id")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "item_id", "score"))),
            lambda r: F.struct(r["item_id"].cast("int").alias(item), r["score"].alias("rating")),
        ).alias("_list")
    )
    empty = F.array().cast(f"array<struct<`{item}`:int,rating:float>>")
    return users.select("id").join(lists, "id", "left").select(
        F.col("id").cast("int").alias(user), F.coalesce("_list", empty).alias("recommendations")
    )


def predictions(recs: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """``user_id``, ``prediction`` array<double>, order kept."""
    ids = F.transform("recommendations", lambda r: r[item].cast("double"))
    return recs.select(user, ids.alias("prediction"))


def ranked_items(recs: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """One row per recommendation: ``user_id``, ``rank`` from 1, ``song_id``, ``score``."""
    rows = recs.select(user, F.posexplode("recommendations").alias("_position", "_rec"))
    return rows.select(
        user,
        (F.col("_position") + 1).alias("rank"),
        F.col("_rec")[item].alias(item),
        F.col("_rec")["rating"].alias("score"),
    )
