"""Ranking quality."""

from __future__ import annotations

from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import columns


def truth_pairs(test: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """Distinct held-out pairs: the truth as rows, whatever the size of a user's set."""
    return test.select(user, item).filter(F.col(user).isNotNull() & F.col(item).isNotNull()).distinct()


def ground_truth(test: DataFrame, user: str = "user_id", item: str = "song_id") -> DataFrame:
    """``user_id``, ``items_true`` sorted array<double>, as MLlib's evaluator wants it.

    An array lives in one row, 8 bytes per distinct song of a user; :func:`ndcg_per_user`
    works on :func:`truth_pairs` and spreads a user's songs.
    """
    return truth_pairs(test, user, item).groupBy(user).agg(
        F.array_sort(F.collect_set(F.col(item).cast("double"))).alias("items_true")
    )


def eval_frame(predictions: DataFrame, truth: DataFrame, user: str = "user_id") -> DataFrame:
    """``user_id``, ``prediction``, ``items_true`` of the users that have both."""
    return predictions.join(truth, user)


def ndcg_evaluator(k: int = 10) -> RankingEvaluator:
    """MLlib's evaluator for :func:`eval_frame`."""
    return RankingEvaluator(
        metricName="ndcgAtK", k=k, labelCol="items_true", predictionCol="prediction"
    )


def ndcg_per_user(
    predictions: DataFrame,
    truth: DataFrame,
    k: int = 10,
    user: str = "user_id",
    item: str = "song_id",
) -> DataFrame:
    """``user_id``, ``ndcg`` of the users with a prediction and a truth.

    ``truth`` holds distinct pairs. Hits come from a join on the pair, so the work
    of a user with a huge truth set is spread over the cluster.
    """
    ranked = predictions.select(
        user, F.posexplode(F.slice("prediction", 1, k)).alias("_position", item)
    )
    # The predicted id takes the type of the true one, so the pairs keep their partitioning.
    ranked = ranked.withColumn(item, F.col(item).cast(truth.schema[item].dataType))
    gains = (
        ranked.join(truth.select(user, item), [user, item])
        .groupBy(user)
        .agg(F.sum(columns.gain(F.col("_position"))).alias("_dcg"))
    )
    sizes = truth.groupBy(user).agg(F.count("*").alias("_n"))
    scored = predictions.select(user).join(sizes, user).join(gains, user, "left")
    return scored.select(
        user,
        (F.coalesce("_dcg", F.lit(0.0)) / columns.ideal_gain(F.col("_n"), k)).alias("ndcg"),
    )


def mean_ndcg(per_user: DataFrame) -> DataFrame:
    """One row: ``users``, ``ndcg`` (0 when nobody could be scored)."""
    return per_user.agg(
        F.count("*").alias("users"), F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg")
    )
