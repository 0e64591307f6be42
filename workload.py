"""The test tables in the roles of the library's inputs, and one query per operator.

Interactions are ``orders`` joined with ``lineitem``; users ``customer``; songs ``part``;
ready-made vectors ``embeddings``.
"""

from __future__ import annotations

import math

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators import (
    best_items,
    evaluate,
    factorize,
    fold_in,
    interactions,
    profiles,
    ranking,
    recommend,
    similar,
    sketches,
    split,
)
from earshot.plans import training
from earshot.sources import models, schemas, sinks, storage, tables

SEED = 42
# Support thresholds that tell a one-pass filter from a filter applied in two steps.
MIN_USER, MIN_ITEM = 30, 25
FIT = {"rank": 8, "iterations": 5}
# Rows of a piece of a layout that is made for a comparison.
ROWS_PER_PIECE = 250_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("l_partkey").cast("long").alias("song_id"),
        F.col("l_quantity").cast("int").alias("play_count"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias("user_id"), F.col("c_name").alias("Username")
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_name"),
    )


def small_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A song dimension that lacks some songs."""
    kept = _table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("song_id"))
    return songs(spark, sf_dir).join(kept, "song_id", "left_semi")


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("features")
    )


def solvent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user dimension that lacks some users."""
    return _table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("long").alias("user_id"), F.col("c_name").alias("Username")
    )


def debtors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of requested ids: the customers in debt."""
    return _table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("long").alias("user_id")
    )


def staged_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interactions joined and written once, for those who read them more than once."""
    return storage.written(plays(spark, sf_dir), "plays")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.clean(staged_plays(spark, sf_dir), MIN_USER, MIN_ITEM)


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.hash_tag(cleaned(spark, sf_dir))


# Per session and data folder: the written split, and the model fitted on it.
_splits: dict[tuple, DataFrame] = {}
_models: dict[tuple, ALSModel] = {}


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The cleaned table with its split, written once and read by every later step."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _splits:
        _splits[key] = storage.written(tagged(spark, sf_dir), "split", "is_train")
    return split.halves(_splits[key])


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _halves(spark, sf_dir)[0]


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _halves(spark, sf_dir)[1]


def test_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.truth_pairs(test_rows(spark, sf_dir))


def fitted(spark: SparkSession, sf_dir: str) -> ALSModel:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        model = factorize.train(training_rows(spark, sf_dir), seed=SEED, **FIT)
        # From here on the factors are read from files, whatever happens to the executors.
        _models[key] = models.load(models.save(model, storage.fresh_path(spark, "fitted")))
    return _models[key]


# Queries -----------------------------------------------------------------------------


def interaction_faults(spark, sf_dir):
    return schemas.interaction_faults(plays(spark, sf_dir))


def support_counts_user(spark, sf_dir):
    return interactions.support_counts(plays(spark, sf_dir), "user_id", "user_n")


def support_counts_song(spark, sf_dir):
    return interactions.support_counts(plays(spark, sf_dir), "song_id", "song_n")


def clean_interactions(spark, sf_dir):
    return cleaned(spark, sf_dir).withColumn("rating_log", F.round("rating_log", 9))


def clean_interactions_shuffled(spark, sf_dir):
    """The same cleaning by the way taken when the counts are too many to broadcast."""
    kept = interactions.clean(
        staged_plays(spark, sf_dir), MIN_USER, MIN_ITEM, max_broadcast_keys=0, rows_per_slice=20
    )
    return kept.withColumn("rating_log", F.round("rating_log", 9))


def cleaning_report(spark, sf_dir):
    raw = staged_plays(spark, sf_dir)
    return interactions.cleaning_report(raw, split.hash_tag(interactions.clean(raw, MIN_USER, MIN_ITEM)))


def user_stats(spark, sf_dir):
    return profiles.user_stats(plays(spark, sf_dir), digits=6)


def user_totals(spark, sf_dir):
    return profiles.user_stats(plays(spark, sf_dir), digits=6, distinct=False)


def user_stats_lookup(spark, sf_dir):
    kept = interactions.support_filter(staged_plays(spark, sf_dir), MIN_USER, MIN_ITEM)
    return profiles.user_stats(kept, ids=debtors(spark, sf_dir), digits=2)


def history_top10(spark, sf_dir):
    return profiles.history(plays(spark, sf_dir), songs(spark, sf_dir), n=10, display=True)


def history_all(spark, sf_dir):
    return profiles.history(plays(spark, sf_dir), songs(spark, sf_dir), n=None)


def history_missing_titles(spark, sf_dir):
    """With a dimension that lacks half of the songs."""
    return profiles.history(plays(spark, sf_dir), small_parts(spark, sf_dir), n=10, display=True)


def history_hot_users(spark, sf_dir):
    """The ranking for users too large for one task, here used from 40 rows on."""
    return ranking.rank_all(plays(spark, sf_dir), "user_id", "song_id", "play_count", rows_per_task=40)


def _weighted(spark, sf_dir):
    """Plays with a fraction, and a column more."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("long").alias("user_id"),
        F.col("l_partkey").cast("long").alias("song_id"),
        (F.round(F.col("l_quantity").cast("double") * 100) / 100 + F.round(F.col("l_discount").cast("double"), 2)).alias("play_count"),
        (F.col("l_orderkey").cast("long") * 10 + F.col("l_linenumber").cast("long")).alias("line"),
    )


def history_fractions(spark, sf_dir):
    """Fractional plays and an extra column by the way for hot users; rows that tie share their ranks' range."""
    ranked = ranking.rank_all(_weighted(spark, sf_dir), "user_id", "song_id", "play_count", rows_per_task=40)
    return _tied_ranks(ranked)


def history_deep(spark, sf_dir):
    """The same cut at a rank beyond the threshold of Spark's early cut."""
    return _tied_ranks(ranking.top_n(_weighted(spark, sf_dir), "user_id", "song_id", "play_count", 1001))


def _tied_ranks(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("user_id", "song_id", F.round("play_count", 2).alias("play_count")).agg(
        F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"), F.sum("line").alias("lines")
    )


def plays_by_user(spark, sf_dir):
    return interactions.by_user(plays(spark, sf_dir))


def user_stats_by_user(spark, sf_dir):
    """The totals from a table kept by user, without a shuffle."""
    return profiles.user_stats(plays_by_user(spark, sf_dir), digits=6)


def history_by_user(spark, sf_dir):
    """The histories from the same table."""
    return profiles.history(plays_by_user(spark, sf_dir), n=10).select("user_id", "rank", "song_id", "play_count")


def distinct_sketches(spark, sf_dir):
    """Different songs per user from sketches by year, merged: whether within four standard errors of the exact count."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("long").alias("user_id"), F.year("o_orderdate").alias("year"))
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").cast("long").alias("song_id"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("user_id", "year", "song_id")
    by_year = storage.written(sketches.sketched(rows, "user_id", "year"), "sketches")
    made = sketches.estimated(sketches.merged(by_year, "user_id"), "estimate")
    exact = rows.groupBy("user_id").agg(F.countDistinct("song_id").alias("distinct_songs"))
    room = F.greatest(F.lit(1.0), 4 * sketches.relative_error() * F.col("distinct_songs"))
    return exact.join(made, "user_id", "left").select(
        "user_id", "distinct_songs", F.coalesce(F.abs(F.col("estimate") - F.col("distinct_songs")) <= room, F.lit(False)).alias("fits")
    )


def history_totals(spark, sf_dir):
    return profiles.history_totals(plays(spark, sf_dir), n=10)


def users_by_id(spark, sf_dir):
    return profiles.for_users(plays(spark, sf_dir), debtors(spark, sf_dir))


def unknown_users(spark, sf_dir):
    return profiles.unknown_users(users(spark, sf_dir), cleaned(spark, sf_dir))


def hash_split(spark, sf_dir):
    return tagged(spark, sf_dir).groupBy("user_id", "is_train").agg(
        F.count("*").alias("n_rows"), F.sum("song_id").alias("song_sum"), F.sum("play_count").alias("plays")
    )


def random_split(spark, sf_dir):
    """Per user the rows of both sides together; over all users, whether each side has its share."""
    train, test = split.random_split(cleaned(spark, sf_dir), SEED)
    both = train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))
    both = storage.written(both, "random-split")
    share = both.agg(F.avg(F.col("is_train").cast("int"))).head()[0]
    return both.groupBy("user_id").agg(
        F.count("*").alias("n_rows"), F.sum("play_count").alias("plays")
    ).withColumn("share_fits", F.lit(abs(share - 0.8) < 0.02))


def random_split_again(spark, sf_dir):
    """Whether another layout of the same rows gets the same split, pair by pair."""
    kept = storage.written(cleaned(spark, sf_dir), "cleaned")
    pair = ["user_id", "song_id", "play_count"]

    # More pieces for more rows, as a task counts the copies of all of its rows.
    pieces = math.ceil(kept.count() / ROWS_PER_PIECE)
    spread = pieces if pieces > int(spark.conf.get("spark.sql.shuffle.partitions")) else None

    def sides(df):
        drawn = split.random_tag(df.select(*pair), SEED, partitions=spread)
        made = drawn.groupBy(*pair).agg(F.count("*").alias("n_rows"), F.count_if("is_train").alias("n_train"))
        return made if spread is None else made.repartition(spread, *pair, "n_rows")

    other = sides(kept.repartition(max(5, pieces), "song_id")).withColumnRenamed("n_train", "n_again")
    return sides(kept.repartition(max(3, pieces))).join(other, [*pair, "n_rows"]).select(
        *pair, "n_rows", (F.col("n_train") == F.col("n_again")).alias("same")
    )


def ground_truth(spark, sf_dir):
    sets = evaluate.ground_truth(test_rows(spark, sf_dir))
    return sets.select("user_id", F.explode("items_true").alias("item_true"))


def truth_pairs(spark, sf_dir):
    return test_pairs(spark, sf_dir)


def nation_favourites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A simple predictor that SQL can repeat: the ten songs with most training rows in the user's nation."""
    nation = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias("user_id"), F.col("c_nationkey").alias("nation")
    )
    favourites = (
        training_rows(spark, sf_dir)
        .join(nation, "user_id")
        .groupBy("nation", "song_id")
        .agg(F.count("*").alias("play_count"))
    )
    top = ranking.top_n(favourites, "nation", "song_id", "play_count", 10)
    lists = top.groupBy("nation").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "song_id"))), lambda s: s["song_id"].cast("double")
        ).alias("prediction")
    )
    return nation.join(lists, "nation").select("user_id", "prediction")


def ndcg_popularity(spark, sf_dir):
    per_user = evaluate.ndcg_per_user(nation_favourites(spark, sf_dir), test_pairs(spark, sf_dir))
    return per_user.withColumn("ndcg", F.round("ndcg", 9))


def mean_ndcg_popularity(spark, sf_dir):
    per_user = evaluate.ndcg_per_user(nation_favourites(spark, sf_dir), test_pairs(spark, sf_dir))
    return evaluate.mean_ndcg(per_user).withColumn("ndcg", F.round("ndcg", 9))


def eval_frame(spark, sf_dir):
    """The evaluator's input, its arrays opened: hits of each listed song."""
    truth = evaluate.ground_truth(test_rows(spark, sf_dir))
    frame = evaluate.eval_frame(nation_favourites(spark, sf_dir), truth)
    return frame.select(
        "user_id",
        F.size("prediction").alias("n_listed"),
        F.size("items_true").alias("n_true"),
        F.size(F.array_intersect("prediction", "items_true")).alias("n_hits"),
    )


def knn_exact(spark, sf_dir):
    found = similar.similar_users(embedding_vectors(spark, sf_dir), k=10, digits=6)
    return found.drop("username")


def knn_exact_cells(spark, sf_dir):
    """The same search by the way taken when the queries are too many to broadcast."""
    found = similar.similar_users(
        embedding_vectors(spark, sf_dir), k=10, digits=6, max_broadcast_bytes=0, rows_per_cell=128
    )
    return found.drop("username")


def knn_named(spark, sf_dir):
    return similar.similar_users(
        embedding_vectors(spark, sf_dir), k=10, digits=4, users=users(spark, sf_dir)
    )


def knn_lsh_wide(spark, sf_dir):
    """With 40 hash tables a near pair shares a bucket for certain: the answer is the exact one."""
    vectors = embedding_vectors(spark, sf_dir)
    index = similar.fit_index(vectors, seed=SEED, tables=40)
    found = similar.similar_users(
        vectors, k=10, method="lsh", index=index, digits=6, max_broadcast_bytes=0, rows_per_cell=128
    )
    return found.drop("username")


def knn_display(spark, sf_dir):
    return similar.similar_users(
        embedding_vectors(spark, sf_dir), k=5, digits=4, users=users(spark, sf_dir), display=True,
    )


def knn_missing_names(spark, sf_dir):
    """With a dimension that lacks some users."""
    return similar.similar_users(
        embedding_vectors(spark, sf_dir), k=5, digits=4,
        users=solvent_users(spark, sf_dir), display=True,
    )


def knn_with_gaps(spark, sf_dir):
    """Every seventh user has no vector, and neither asks nor answers."""
    vectors = embedding_vectors(spark, sf_dir).withColumn("features", F.when(F.col("id") % 7 != 0, F.col("features")))
    return similar.similar_users(vectors, k=10, digits=6).drop("username")


def _with_own_distance(found, vectors):
    """Whether each neighbour's distance is that of the two vectors, and its rank in order."""
    one = vectors.select(F.col("id").cast("long").alias("query_id"), F.col("features").alias("x"))
    two = vectors.select(F.col("id").cast("long").alias("neighbor_id"), F.col("features").alias("y"))
    squares = F.aggregate(
        F.zip_with("x", "y", lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda t, v: t + v
    )
    return found.join(one, "query_id").join(two, "neighbor_id").withColumn("true_dist", F.sqrt(squares)).drop("x", "y")


def _checked_neighbours(found, vectors, k, others):
    """Per query: at most ``k`` neighbours, none itself, ranks without a gap in the order of true distances.

    ``others``: whether every query has a neighbour at all.
    """
    rows = _with_own_distance(found, vectors)
    per_query = rows.groupBy("query_id").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.countDistinct("neighbor_id").alias("n_different"),
        F.max(F.abs(F.col("dist") - F.col("true_dist"))).alias("error"),
        F.count_if(F.col("query_id") == F.col("neighbor_id")).alias("n_self"),
        F.sort_array(F.collect_list(F.struct("rank", "dist", "neighbor_id"))).alias("list"),
    )
    ordered = F.forall(
        F.sequence(F.lit(1), F.size("list")),
        lambda i: (i == 1) | (
            F.struct(F.get("list", i - 2)["dist"], F.get("list", i - 2)["neighbor_id"])
            < F.struct(F.get("list", i - 1)["dist"], F.get("list", i - 1)["neighbor_id"])
        ),
    )
    asked = vectors.select(F.col("id").cast("long").alias("query_id"))
    return (asked if others else asked.join(per_query.select("query_id"), "query_id", "left_semi")).join(
        per_query, "query_id", "left"
    ).select(
        "query_id",
        ((F.col("n") <= k) & (F.col("n") == F.col("last")) & (F.col("n") == F.col("n_different")) & (F.col("n_self") == 0)).alias("whole"),
        ((F.col("error") < 1e-4) & ordered).alias("in_order"),
    )


def knn_lsh(spark, sf_dir):
    """The LSH answers of all users: each a valid list of true distances."""
    vectors = embedding_vectors(spark, sf_dir)
    index = similar.fit_index(vectors, seed=SEED)
    return _checked_neighbours(similar.similar_users(vectors, k=10, index=index, digits=6), vectors, 10, others=True)


def als_similar_users(spark, sf_dir):
    """The same over learnt vectors."""
    vectors = storage.written(factorize.user_vectors(fitted(spark, sf_dir)), "vectors")
    found = similar.similar_users(vectors, k=10, index=similar.fit_index(vectors, seed=SEED))
    return _checked_neighbours(found, vectors, 10, others=True)


def als_similar_to_one(spark, sf_dir):
    """The same for one user."""
    vectors = storage.written(factorize.user_vectors(fitted(spark, sf_dir)), "vectors")
    user_id = vectors.agg(F.min("id")).head()[0]
    found = similar.similar_to(vectors, user_id, similar.fit_index(vectors, seed=SEED), k=10)
    return _checked_neighbours(found, vectors, 10, others=False)


def _recall_row(found, vectors, wanted=0.9):
    exact = similar.similar_users(vectors, k=10, method="exact", digits=6)
    return similar.recall(found, exact).select(
        "pairs_exact", (F.col("recall") >= wanted).alias("recall_fits"), (F.col("pairs_found") <= F.col("pairs_exact")).alias("none_made_up")
    )


def lsh_recall(spark, sf_dir):
    """With a bucket length calibrated to a recall of nine tenths, the recall measured over all vectors."""
    vectors = embedding_vectors(spark, sf_dir)
    made = similar.calibrate(vectors, seed=SEED, recall=0.9)
    return _recall_row(similar.similar_users(vectors, k=10, index=made.index, digits=6), vectors).withColumn(
        "prunes", F.lit(made.compared < 1.0)
    )


def lsh_multi_probe(spark, sf_dir):
    """The same with six neighbouring buckets probed, and so with shorter buckets."""
    vectors = embedding_vectors(spark, sf_dir)
    plain, made = (similar.calibrate(vectors, seed=SEED, recall=0.9, probes=p) for p in (0, 6))
    found = similar.similar_users(vectors, k=10, index=made.index, probes=made.probes, digits=6)
    return _recall_row(found, vectors).withColumn(
        "shorter", F.lit(made.index.getBucketLength() < plain.index.getBucketLength())
    )


def lsh_recall_shipped(spark, sf_dir):
    """Recall of the default index, over ready-made and over learnt vectors."""
    learnt = storage.written(factorize.user_vectors(fitted(spark, sf_dir)), "vectors")
    rows = []
    for name, vectors in (("embeddings", embedding_vectors(spark, sf_dir)), ("users", learnt)):
        found = similar.similar_users(vectors, k=10, index=similar.fit_index(vectors, seed=SEED), digits=6)
        rows.append(_recall_row(found, vectors).withColumn("vectors", F.lit(name)))
    return rows[0].unionByName(rows[1])


def lsh_buckets(spark, sf_dir):
    """Per hash table, whether the buckets hold every vector once."""
    vectors = embedding_vectors(spark, sf_dir)
    found = similar.bucket_profile(vectors, similar.fit_index(vectors, seed=SEED))
    return found.select("table", "vectors", (F.col("largest") <= F.col("vectors")).alias("largest_fits"))


def als_user_factors(spark, sf_dir):
    """Per user, whether the vector has its length, no negative entry, and solves its least squares.

    The fit ends with the users, so each user's vector x minimises its own problem under
    the final song vectors: the slope is 0 where x is positive, and not negative elsewhere.
    """
    model, rank, reg, alpha = fitted(spark, sf_dir), FIT["rank"], 0.1, 1.0
    items = factorize.item_vectors(model)
    entries = items.select("id", F.posexplode("features").alias("i", "a")).join(
        items.select("id", F.posexplode("features").alias("j", "b")), "id"
    )
    gram = [[0.0] * rank for _ in range(rank)]
    for r in entries.groupBy("i", "j").agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("s")).collect():
        gram[r.i][r.j] = r.s  # rank times rank numbers
    ratings = training_rows(spark, sf_dir).select("user_id", "song_id", "rating_log")
    rated = ratings.join(
        items.select(F.col("id").cast("long").alias("song_id"), F.col("features").cast("array<double>").alias("y")), "song_id"
    ).join(
        factorize.user_vectors(model).select(
            F.col("id").cast("long").alias("user_id"), F.col("features").cast("array<double>").alias("x")
        ), "user_id",
    )
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    weight = alpha * F.col("rating_log")
    # What one rating adds to the slope, and to the scale it is judged by.
    part = F.col("_weight") * F.col("_dot") - (1 + F.col("_weight"))
    parts = rated.withColumn("_weight", weight).withColumn("_dot", dot)
    sums = parts.groupBy("user_id", "x").agg(
        F.count("*").alias("n"),
        *[F.sum(part * F.col("y")[i]).alias(f"s{i}") for i in range(rank)],
        *[F.sum((1 + F.col("_weight")) * F.abs(F.col("y")[i])).alias(f"z{i}") for i in range(rank)],
    )
    scale = F.greatest(*[F.col(f"z{i}") for i in range(rank)])
    solved = F.lit(True)
    for i in range(rank):
        slope = F.col(f"s{i}") + reg * F.col("n") * F.col("x")[i]
        for j in range(rank):
            slope = slope + gram[i][j] * F.col("x")[j]
        solved = solved & (slope >= -1e-3 * scale) & (F.abs(slope * F.col("x")[i]) <= 1e-3 * scale)
    return sums.select(
        "user_id", (F.size("x") == rank).alias("length_fits"), F.forall("x", lambda v: v >= 0).alias("not_negative"),
        solved.alias("solved"),
    )


def _ranked_top(spark, sf_dir):
    return recommend.ranked_items(recommend.top_items(fitted(spark, sf_dir), 10))


def _best_possible(spark, sf_dir, listed, k):
    """Per user, whether the songs listed score, rank by rank, what the search by blocks finds best."""
    model = fitted(spark, sf_dir)
    asked = listed.select("user_id").distinct()
    best = best_items.search(factorize.user_vectors(model), factorize.item_vectors(model), k, asked).best
    both = listed.join(best.select("user_id", "rank", F.col("score").alias("_best")), ["user_id", "rank"], "full")
    return both.groupBy(F.col("user_id").cast("int").alias("user_id")).agg(
        (F.count("score") == k).alias("full"),
        F.coalesce(F.max(F.abs(F.col("score") - F.col("_best"))) < 1e-4, F.lit(False)).alias("best"),
    )


def als_top_items(spark, sf_dir):
    return _best_possible(spark, sf_dir, _ranked_top(spark, sf_dir), 10)


def als_top_items_subset(spark, sf_dir):
    recs = recommend.top_items(fitted(spark, sf_dir), 5, users=debtors(spark, sf_dir))
    return _best_possible(spark, sf_dir, recommend.ranked_items(recs), 5)


def als_top_items_unseen(spark, sf_dir):
    """Recommendations without the songs of the training rows: how many, whether none was played, and whether in order."""
    model, rows = fitted(spark, sf_dir), training_rows(spark, sf_dir)
    recs = recommend.top_items(model, 10, exclude_seen=rows.select("user_id", "song_id"))
    ranked = storage.written(recommend.ranked_items(recs), "unseen")
    played = rows.select("user_id", "song_id").distinct().withColumn("_played", F.lit(True))
    return ranked.join(played, ["user_id", "song_id"], "left").groupBy(F.col("user_id").cast("int").alias("user_id")).agg(
        F.count("*").alias("n_listed"), (F.count("_played") == 0).alias("none_played"),
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("_scores"),
    ).withColumn("in_order", F.col("_scores") == F.sort_array("_scores", asc=False)).drop("_scores")


def als_blocks(spark, sf_dir):
    """The search in many blocks: whether it gives the scores of the listed songs and the trainer's, and its count of blocks searched adds up."""
    model = fitted(spark, sf_dir)
    found = best_items.search(factorize.user_vectors(model), factorize.item_vectors(model), 10, rows_per_block=256)
    ranked = _ranked_top(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("long"))
    # The trainer's own score of every pair found.
    scored = model.transform(found.best.select(F.col("user_id").cast("int"), "rank", F.col("item_id").cast("int").alias("song_id"), "score"))
    scored = scored.select(F.col("user_id").cast("long").alias("user_id"), "rank", "score", F.col("prediction").alias("_trained"))
    same = scored.join(ranked.withColumnRenamed("score", "_theirs"), ["user_id", "rank"], "full").agg(
        F.countDistinct("user_id").alias("users"),
        F.coalesce(
            (F.max(F.abs(F.col("score") - F.col("_theirs"))) < 1e-4) & (F.max(F.abs(F.col("score") - F.col("_trained"))) < 1e-4), F.lit(False)
        ).alias("same"),
        (F.count("score") == F.count("_theirs")).alias("as_many"),
    )
    sums = found.report.agg(F.sum("searched"), F.sum("pairs")).head()  # a row per wave
    return same.withColumn("adds_up", F.lit(0 < sums[0] <= sums[1]))


def als_fold_in(spark, sf_dir):
    """Known users folded in from their training rows: whether they get their own vector."""
    model = fitted(spark, sf_dir)
    made = fold_in.fold_in(training_rows(spark, sf_dir), factorize.item_vectors(model)).withColumnRenamed("features", "made")
    gaps = F.zip_with("features", "made", lambda a, b: F.abs(a - b))
    return factorize.user_vectors(model).withColumn("id", F.col("id").cast("long")).join(made, "id", "left").select(
        F.col("id").alias("user_id"), F.coalesce(F.array_max(gaps) < 1e-3, F.lit(False)).alias("same")
    )


def als_fold_in_unknown(spark, sf_dir):
    """Users the model does not know get recommendations from their own plays: how many, none of them played."""
    model = fitted(spark, sf_dir)
    known = factorize.user_vectors(model).select(F.col("id").cast("long").alias("user_id"))
    rows = storage.written(interactions.log_rating(plays(spark, sf_dir).join(known, "user_id", "left_anti")), "unknown-plays")
    vectors = storage.written(fold_in.fold_in(rows, factorize.item_vectors(model)), "folded")
    found = best_items.search(vectors, factorize.item_vectors(model), 10, seen=rows.select("user_id", "song_id"))
    played = rows.select("user_id", F.col("song_id").alias("item_id")).distinct().withColumn("_played", F.lit(True))
    return found.best.join(played, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count("*").alias("n_listed"), (F.count("_played") == 0).alias("none_played")
    )


def als_predictions(spark, sf_dir):
    """Per user, whether the listed ids are the ranked songs in their order."""
    recs = recommend.top_items(fitted(spark, sf_dir), 10)
    ranked = recommend.ranked_items(recs).groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "song_id"))), lambda r: r["song_id"].cast("double")).alias("songs")
    )
    return recommend.predictions(recs).join(ranked, "user_id").select(
        "user_id", F.size("prediction").alias("n_listed"), (F.col("prediction") == F.col("songs")).alias("same")
    )


def als_top_items_shape(spark, sf_dir):
    """Every trained user gets ten different trained songs, ranked 1 to 10."""
    return _ranked_top(spark, sf_dir).groupBy("user_id").agg(
        F.countDistinct("song_id").alias("n_songs"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
    )


def als_top_items_scores(spark, sf_dir):
    """Whether each recommendation's score is the product of the two factors."""
    model = fitted(spark, sf_dir)
    own = factorize.user_vectors(model).select(F.col("id").alias("user_id"), F.col("features").alias("x"))
    other = factorize.item_vectors(model).select(F.col("id").alias("song_id"), F.col("features").alias("y"))
    product = F.aggregate(
        F.zip_with("x", "y", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda total, v: total + v
    )
    recs = recommend.ranked_items(recommend.top_items(model, 10))
    return recs.join(own, "user_id").join(other, "song_id").select(
        "user_id", "rank", (F.abs(product - F.col("score")) < 1e-5).alias("same")
    )


def als_ndcg(spark, sf_dir):
    """Users scored, and whether the mean is that of MLlib's evaluator and within its bounds."""
    listed = recommend.predictions(recommend.top_items(fitted(spark, sf_dir), 10))
    frame = evaluate.eval_frame(listed, evaluate.ground_truth(test_rows(spark, sf_dir)))
    theirs = evaluate.ndcg_evaluator(10).evaluate(frame)
    return evaluate.mean_ndcg(evaluate.ndcg_per_user(listed, test_pairs(spark, sf_dir))).select(
        "users", F.col("ndcg").between(0.0, 1.0).alias("bounded"),
        (F.abs(F.col("ndcg") - theirs) < 1e-9).alias("as_evaluator"),
    )


def similar_listeners(spark, sf_dir):
    """Clean, train, and find similar users with their names."""
    vectors = factorize.user_vectors(fitted(spark, sf_dir))
    index = similar.fit_index(vectors, seed=SEED)
    return similar.similar_users(
        vectors, k=10, method="lsh", index=index, users=users(spark, sf_dir), digits=4
    )


def _checked_metrics(metrics: DataFrame) -> DataFrame:
    """Per combination its parameters and users, and whether the one marked best is the first of the highest score."""
    best = metrics.agg(F.max("ndcg")).head()[0]
    marked = metrics.filter("is_best").select("ndcg").collect()  # one row per combination
    fits = len(marked) == 1 and marked[0].ndcg == best
    return metrics.select(
        "rank", "reg", "alpha", "iterations", "users", F.col("ndcg").between(0.0, 1.0).alias("bounded"),
        F.lit(fits).alias("one_best"),
    )


def grid_metrics(spark, sf_dir):
    result = training.grid_search(
        training_rows(spark, sf_dir), test_rows(spark, sf_dir), seed=SEED, ranks=(4, 8), regs=(0.1,), alphas=(1.0,), iterations=(3,)
    )
    return _checked_metrics(result.metrics)


def train_and_save(spark, sf_dir):
    """Clean, split, search, save: rows before and after, and what was saved."""
    path = storage.fresh_path(spark, "trained")
    result = training.train_and_save(
        staged_plays(spark, sf_dir), path, seed=SEED, min_user=MIN_USER, min_item=MIN_ITEM, ranks=(4,), iterations=(2,)
    )
    saved = models.describe(models.load(path)).select(F.col("rank").alias("saved_rank"))
    return result.report.crossJoin(F.broadcast(saved)).select(
        "rows_before", "rows_after", (F.col("train_rows") + F.col("test_rows")).alias("rows_split"), "saved_rank"
    )


def _as_csv(spark: SparkSession, df: DataFrame) -> str:
    path = storage.fresh_path(spark, "csv")
    df.write.csv(path, header=True)
    return path


def csv_roundtrip(spark, sf_dir):
    """The interactions through a CSV in which some whole numbers are written as decimals."""
    def mixed(name, often):
        value = F.col(name).cast("string")
        return F.when(F.col("song_id") % often == 0, F.concat(value, F.lit(".0"))).otherwise(value).alias(name)

    path = _as_csv(spark, plays(spark, sf_dir).select(mixed("user_id", 3), mixed("song_id", 5), mixed("play_count", 2)))
    return tables.read_interactions(spark, path)


def csv_users(spark, sf_dir):
    path = _as_csv(spark, users(spark, sf_dir).withColumn("user_id", F.concat(F.col("user_id"), F.lit(".0"))))
    return tables.read_dimension(spark, path, schemas.USERS)


def csv_songs(spark, sf_dir):
    return tables.read_dimension(spark, _as_csv(spark, songs(spark, sf_dir)), schemas.SONGS)


def csv_faults(spark, sf_dir):
    """Cells that hold something and cannot be read, by column; every eleventh song's plays are words."""
    broken = F.when(F.col("song_id") % 11 == 0, F.lit("many")).otherwise(F.col("play_count").cast("string"))
    path = _as_csv(spark, plays(spark, sf_dir).withColumn("play_count", broken))
    return tables.unreadable_cells(spark, path, schemas.INTERACTIONS)


def sinks_roundtrip(spark, sf_dir):
    """The ten most played of everyone, some titles missing, written in every format and read again."""
    ranked = storage.written(
        profiles.history(plays(spark, sf_dir), small_parts(spark, sf_dir), 10), "ranked"
    )
    again = None
    for fmt in sinks.FORMATS:
        path = sinks.write(ranked, storage.fresh_path(spark, fmt), fmt)
        rows = sinks.read(spark, path, ranked, fmt).select(F.lit(fmt).alias("sink"), "*")
        again = rows if again is None else again.unionByName(rows)
    return again


def input_presence(spark, sf_dir):
    """Which inputs are there, and their rows; two optional inputs are not, and count as 0 here."""
    path = f"{sf_dir}/{{}}.parquet".format
    return tables.input_report(
        spark, {"orders": path("orders"), "lineitem": path("lineitem")},
        {"users": path("customer"), "songs": path("part"), "titles": path("no_such_table"), "none": None},
    ).fillna(0, ["n_rows"])


def als_checkpointed(spark, sf_dir):
    """Users whose vector is the same whether the trainer cuts its lineage in the shared folder or not."""
    rows = training_rows(spark, sf_dir)
    # One number for both fits, and more blocks than four for many rows, as a block is one task.
    blocks = max(4, factorize.block_count(rows.count(), spark.sparkContext.defaultParallelism, FIT["rank"]))
    fits = [factorize.train(rows, seed=SEED, blocks=blocks, checkpoint_interval=every, **FIT) for every in (2, FIT["iterations"])]
    cut, whole = (factorize.user_vectors(m) for m in fits)
    near = F.forall(F.zip_with("features", "other", lambda a, b: F.abs(a - b) <= 1e-4 * (1 + F.abs(b))), lambda x: x)
    return cut.join(whole.withColumnRenamed("features", "other"), "id").select(
        F.col("id").cast("long").alias("user_id"), near.alias("same")
    )


def model_roundtrip(spark, sf_dir):
    """Users whose vector is the same after saving and loading."""
    model = fitted(spark, sf_dir)
    again = models.load(models.save(model, storage.fresh_path(spark, "model")))
    before = factorize.user_vectors(model)
    after = factorize.user_vectors(again).withColumnRenamed("features", "loaded")
    return before.join(after, "id").select(
        F.col("id").cast("long").alias("user_id"), (F.col("features") == F.col("loaded")).alias("same")
    )


def model_describe(spark, sf_dir):
    return models.describe(fitted(spark, sf_dir))


def model_users(spark, sf_dir):
    """Users of the cleaned table that the model does not know: all their pairs were held out."""
    known = factorize.user_vectors(fitted(spark, sf_dir)).select(F.col("id").cast("long").alias("user_id"))
    return profiles.unknown_users(tables.user_ids(plays(spark, sf_dir)), known)


QUERIES = {
    f.__name__: f
    for f in (
        interaction_faults, support_counts_user, support_counts_song, clean_interactions,
        clean_interactions_shuffled, cleaning_report, user_stats, user_totals, user_stats_lookup,
        history_top10, history_all, history_missing_titles, history_hot_users, history_fractions, history_deep,
        history_by_user, user_stats_by_user, distinct_sketches, history_totals, users_by_id, unknown_users, hash_split, random_split, random_split_again, ground_truth,
        truth_pairs, ndcg_popularity, mean_ndcg_popularity, eval_frame, knn_exact, knn_exact_cells, knn_named,
        knn_display, knn_missing_names, knn_with_gaps, knn_lsh, knn_lsh_wide, lsh_recall,
        lsh_multi_probe, lsh_recall_shipped, lsh_buckets, als_user_factors, als_top_items, als_top_items_subset,
        als_top_items_unseen, als_blocks, als_fold_in, als_fold_in_unknown, als_predictions, als_top_items_shape,
        als_top_items_scores, als_ndcg, als_similar_users, als_similar_to_one, grid_metrics, train_and_save,
        csv_roundtrip, csv_users, csv_songs, csv_faults, sinks_roundtrip, input_presence, als_checkpointed,
        model_roundtrip, model_describe, model_users,
    )
}

# The same answers in SQL -------------------------------------------------------------

_PLAYS = """
plays AS (
  SELECT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS song_id, l_quantity::INT AS play_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_KEPT = f"""{_PLAYS},
user_counts AS (SELECT user_id, count(*) AS user_n FROM plays GROUP BY user_id),
song_counts AS (SELECT song_id, count(*) AS song_n FROM plays GROUP BY song_id),
kept AS (
  SELECT * FROM plays JOIN user_counts USING (user_id) JOIN song_counts USING (song_id)
  WHERE user_n >= {MIN_USER} AND song_n >= {MIN_ITEM}
),
tagged AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', user_id, song_id)), 1, 4))::INT % 10 < 8 AS is_train
  FROM kept
)"""

_RANKED = f"""{_PLAYS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, song_id) AS rank FROM plays
),
songs AS (
  SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_name FROM part
)"""

_TIED = """
SELECT user_id, song_id, play_count, min(first) AS first_rank, max(first) + count(*) - 1 AS last_rank,
  sum(line)::BIGINT AS lines
FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY play_count DESC, song_id) AS first FROM (
    SELECT o_custkey::BIGINT AS user_id, l_partkey::BIGINT AS song_id,
      round(round(l_quantity::DOUBLE * 100) / 100 + round(l_discount::DOUBLE, 2), 2) AS play_count,
      l_orderkey::BIGINT * 10 + l_linenumber AS line
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  )
) GROUP BY user_id, song_id, play_count"""

_NDCG = f"""{_KEPT},
favourites AS (
  SELECT c_nationkey AS nation, song_id, count(*) AS n
  FROM tagged JOIN customer ON c_custkey = user_id WHERE is_train GROUP BY ALL
),
listed AS (
  SELECT nation, song_id, row_number() OVER (PARTITION BY nation ORDER BY n DESC, song_id) AS rank
  FROM favourites QUALIFY rank <= 10
),
predicted AS (
  SELECT c_custkey::BIGINT AS user_id, song_id, rank FROM customer JOIN listed ON c_nationkey = nation
),
truth AS (SELECT DISTINCT user_id, song_id FROM tagged WHERE NOT is_train),
sizes AS (SELECT user_id, count(*) AS n FROM truth GROUP BY user_id),
hits AS (
  SELECT user_id, sum(1 / ln(rank + 1)) AS dcg, count(*) AS n_hits
  FROM predicted JOIN truth USING (user_id, song_id) GROUP BY user_id
),
ideal AS (SELECT n, sum(1 / ln(i + 1)) AS best FROM range(1, 11) a(n), range(1, 11) b(i) WHERE i <= n GROUP BY n),
scored AS (
  SELECT s.user_id, coalesce(dcg, 0) / best AS ndcg, s.n, coalesce(n_hits, 0) AS n_hits
  FROM sizes s JOIN (SELECT DISTINCT user_id FROM predicted) p ON p.user_id = s.user_id
  JOIN ideal ON ideal.n = least(s.n, 10) LEFT JOIN hits h ON h.user_id = s.user_id
)"""


def _knn(digits: int, k: int = 10) -> str:
    return f"""
pairs AS (
  SELECT a.vec_id::BIGINT AS query_id, b.vec_id::BIGINT AS neighbor_id,
    round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), {digits}) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
),
nearest AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY dist, neighbor_id))::INT AS rank,
    neighbor_id, dist
  FROM pairs QUALIFY rank <= {k}
)"""


_TRAINED = f"{_KEPT}, trained AS (SELECT user_id, song_id FROM tagged WHERE is_train)"
_RANK_ALL = f"WITH {_RANKED} SELECT user_id, song_id, play_count, rank FROM ranked"

_CLEAN = f"""WITH {_KEPT} SELECT user_id, song_id, play_count, user_n, song_n,
        round(ln(1 + play_count), 9) AS rating_log FROM kept"""

ORACLE = {
    "interaction_faults": f"""WITH {_PLAYS} SELECT count(*) AS rows,
        count(*) FILTER (user_id IS NULL OR song_id IS NULL) AS null_ids,
        count(*) FILTER (greatest(user_id, song_id) > 2147483647 OR least(user_id, song_id) < -2147483648) AS unusable_ids,
        count(*) FILTER (play_count IS NULL) AS null_plays,
        count(*) FILTER (play_count < 0) AS negative_plays FROM plays""",
    "support_counts_user": f"WITH {_PLAYS} SELECT user_id, count(*) AS user_n FROM plays GROUP BY user_id",
    "support_counts_song": f"WITH {_PLAYS} SELECT song_id, count(*) AS song_n FROM plays GROUP BY song_id",
    "clean_interactions": _CLEAN,
    "clean_interactions_shuffled": _CLEAN,
    "cleaning_report": f"""WITH {_KEPT} SELECT (SELECT count(*) FROM plays) AS rows_before,
        count(*) AS rows_after, count(*) FILTER (is_train) AS train_rows,
        count(*) FILTER (NOT is_train) AS test_rows,
        count(DISTINCT user_id) FILTER (NOT is_train) AS test_users FROM tagged""",
    "user_stats": f"""WITH {_PLAYS} SELECT user_id, count(song_id) AS total_songs,
        count(DISTINCT song_id) AS distinct_songs, sum(play_count)::BIGINT AS total_plays,
        round(avg(play_count), 6) AS avg_plays FROM plays GROUP BY user_id""",
    "user_stats_by_user": f"""WITH {_PLAYS} SELECT user_id, count(song_id) AS total_songs,
        count(DISTINCT song_id) AS distinct_songs, sum(play_count)::BIGINT AS total_plays,
        round(avg(play_count), 6) AS avg_plays FROM plays GROUP BY user_id""",
    "user_totals": f"""WITH {_PLAYS} SELECT user_id, count(song_id) AS total_songs,
        sum(play_count)::BIGINT AS total_plays, round(avg(play_count), 6) AS avg_plays
        FROM plays GROUP BY user_id""",
    "user_stats_lookup": f"""WITH {_KEPT} SELECT c_custkey::BIGINT AS user_id, count(song_id) AS total_songs,
        count(DISTINCT song_id) AS distinct_songs, coalesce(sum(play_count), 0)::BIGINT AS total_plays,
        round(avg(play_count), 2) AS avg_plays
        FROM customer LEFT JOIN kept ON user_id = c_custkey WHERE c_acctbal < 0 GROUP BY c_custkey""",
    "history_top10": f"""WITH {_RANKED} SELECT user_id, rank, song_id, play_count,
        substr(coalesce(nullif(title, ''), 'Desconocida'), 1, 33) AS title,
        substr(coalesce(nullif(artist_name, ''), 'Desconocido'), 1, 33) AS artist_name
        FROM ranked LEFT JOIN songs USING (song_id) WHERE rank <= 10""",
    "history_all": f"""WITH {_RANKED} SELECT user_id, rank, song_id, play_count, title, artist_name
        FROM ranked LEFT JOIN songs USING (song_id)""",
    "history_by_user": f"WITH {_RANKED} SELECT user_id, rank, song_id, play_count FROM ranked WHERE rank <= 10",
    "distinct_sketches": f"""WITH {_PLAYS} SELECT user_id, count(DISTINCT song_id) AS distinct_songs, true AS fits
        FROM plays GROUP BY user_id""",
    "history_missing_titles": f"""WITH {_RANKED} SELECT user_id, rank, song_id, play_count,
        substr(coalesce(nullif(p_name, ''), 'Desconocida'), 1, 33) AS title,
        substr(coalesce(nullif(p_brand, ''), 'Desconocido'), 1, 33) AS artist_name
        FROM ranked LEFT JOIN part ON p_partkey = song_id AND p_size <= 25 WHERE rank <= 10""",
    "history_hot_users": _RANK_ALL,
    "history_fractions": _TIED,
    "history_deep": _TIED,
    "history_totals": f"""WITH {_RANKED} SELECT user_id, count(*) AS songs_shown,
        sum(play_count)::BIGINT AS plays_shown FROM ranked WHERE rank <= 10 GROUP BY user_id""",
    "users_by_id": f"""WITH {_PLAYS} SELECT user_id, song_id, play_count FROM plays
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "unknown_users": f"""WITH {_KEPT} SELECT c_custkey::BIGINT AS user_id FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM kept)""",
    "hash_split": f"""WITH {_KEPT} SELECT user_id, is_train, count(*) AS n_rows,
        sum(song_id)::BIGINT AS song_sum, sum(play_count)::BIGINT AS plays
        FROM tagged GROUP BY user_id, is_train""",
    "random_split": f"""WITH {_KEPT} SELECT user_id, count(*) AS n_rows,
        sum(play_count)::BIGINT AS plays, true AS share_fits FROM kept GROUP BY user_id""",
    "random_split_again": f"""WITH {_KEPT} SELECT user_id, song_id, play_count, count(*) AS n_rows,
        true AS same FROM kept GROUP BY ALL""",
    "ground_truth": f"""WITH {_KEPT} SELECT DISTINCT user_id, song_id::DOUBLE AS item_true
        FROM tagged WHERE NOT is_train""",
    "truth_pairs": f"WITH {_KEPT} SELECT DISTINCT user_id, song_id FROM tagged WHERE NOT is_train",
    "ndcg_popularity": f"WITH {_NDCG} SELECT user_id, round(ndcg, 9) AS ndcg FROM scored",
    "mean_ndcg_popularity": f"WITH {_NDCG} SELECT count(*) AS users, round(avg(ndcg), 9) AS ndcg FROM scored",
    "eval_frame": f"""WITH {_NDCG}, lengths AS (SELECT user_id, count(*) AS n_listed FROM predicted GROUP BY user_id)
        SELECT user_id, n_listed::INT AS n_listed, n::INT AS n_true, n_hits::INT AS n_hits
        FROM scored JOIN lengths USING (user_id)""",
    "knn_exact": f"WITH {_knn(6)} SELECT * FROM nearest",
    "knn_exact_cells": f"WITH {_knn(6)} SELECT * FROM nearest",
    "knn_named": f"""WITH {_knn(4)} SELECT query_id, rank, neighbor_id, dist, c_name AS username
        FROM nearest LEFT JOIN customer ON c_custkey = neighbor_id""",
    "knn_lsh_wide": f"WITH {_knn(6)} SELECT * FROM nearest",
    "knn_display": f"""WITH {_knn(4, 5)} SELECT query_id, rank, neighbor_id, dist,
        coalesce(c_name, 'N/A') AS username FROM nearest LEFT JOIN customer ON c_custkey = neighbor_id""",
    "knn_missing_names": f"""WITH {_knn(4, 5)} SELECT query_id, rank, neighbor_id, dist,
        coalesce(c_name, 'N/A') AS username
        FROM nearest LEFT JOIN customer ON c_custkey = neighbor_id AND c_acctbal >= 0""",
    "knn_with_gaps": f"""WITH {_knn(6).replace('a.vec_id <> b.vec_id', 'a.vec_id <> b.vec_id AND a.vec_id % 7 <> 0 AND b.vec_id % 7 <> 0')}
        SELECT * FROM nearest""",
    "knn_lsh": "SELECT vec_id::BIGINT AS query_id, true AS whole, true AS in_order FROM embeddings",
    "lsh_recall": "SELECT 10 * count(*) AS pairs_exact, true AS recall_fits, true AS none_made_up, true AS prunes FROM embeddings",
    "lsh_multi_probe": "SELECT 10 * count(*) AS pairs_exact, true AS recall_fits, true AS none_made_up, true AS shorter FROM embeddings",
    "lsh_recall_shipped": f"""WITH {_TRAINED} SELECT 10 * count(*) AS pairs_exact, true AS recall_fits, true AS none_made_up,
        'embeddings' AS vectors FROM embeddings
        UNION ALL SELECT 10 * count(DISTINCT user_id), true, true, 'users' FROM trained""",
    "lsh_buckets": """SELECT t::INT AS "table", count(*) AS vectors, true AS largest_fits
        FROM embeddings, range(5) r(t) GROUP BY t""",
    "als_user_factors": f"""WITH {_TRAINED} SELECT DISTINCT user_id, true AS length_fits, true AS not_negative,
        true AS solved FROM trained""",
    "als_top_items": f"WITH {_TRAINED} SELECT DISTINCT user_id::INT AS user_id, true AS full, true AS best FROM trained",
    "als_top_items_subset": f"""WITH {_TRAINED} SELECT DISTINCT user_id::INT AS user_id, true AS full, true AS best
        FROM trained JOIN customer ON c_custkey = user_id WHERE c_acctbal < 0""",
    "als_top_items_unseen": f"""WITH {_TRAINED}, n_songs AS (SELECT count(DISTINCT song_id) AS n FROM trained)
        SELECT user_id::INT AS user_id, least(10, any_value(n) - count(DISTINCT song_id)) AS n_listed, true AS none_played, true AS in_order
        FROM trained, n_songs GROUP BY user_id""",
    "als_blocks": f"WITH {_TRAINED} SELECT count(DISTINCT user_id) AS users, true AS same, true AS as_many, true AS adds_up FROM trained",
    "als_fold_in": f"WITH {_TRAINED} SELECT DISTINCT user_id, true AS same FROM trained",
    "als_fold_in_unknown": f"""WITH {_TRAINED}, songs AS (SELECT DISTINCT song_id FROM trained),
        own AS (SELECT DISTINCT user_id, song_id FROM plays JOIN songs USING (song_id) WHERE user_id NOT IN (SELECT user_id FROM trained))
        SELECT user_id, least(10, (SELECT count(*) FROM songs) - count(*)) AS n_listed, true AS none_played FROM own GROUP BY user_id""",
    "als_predictions": f"WITH {_TRAINED} SELECT DISTINCT user_id::INT AS user_id, 10 AS n_listed, true AS same FROM trained",
    "als_ndcg": f"""WITH {_TRAINED}, held AS (SELECT DISTINCT user_id FROM tagged WHERE NOT is_train)
        SELECT count(*) AS users, true AS bounded, true AS as_evaluator
        FROM held WHERE user_id IN (SELECT user_id FROM trained)""",
    "als_similar_users": f"WITH {_TRAINED} SELECT DISTINCT user_id AS query_id, true AS whole, true AS in_order FROM trained",
    "als_similar_to_one": f"WITH {_TRAINED} SELECT min(user_id) AS query_id, true AS whole, true AS in_order FROM trained",
    "grid_metrics": f"""WITH {_TRAINED}, held AS (SELECT DISTINCT user_id FROM tagged WHERE NOT is_train)
        SELECT r::INT AS rank, 0.1::DOUBLE AS reg, 1.0::DOUBLE AS alpha, 3 AS iterations, count(*) AS users,
        true AS bounded, true AS one_best
        FROM held, (VALUES (4), (8)) v(r) WHERE user_id IN (SELECT user_id FROM trained) GROUP BY r""",
    "train_and_save": f"""WITH {_KEPT} SELECT (SELECT count(*) FROM plays) AS rows_before, count(*) AS rows_after,
        count(*) AS rows_split, 4 AS saved_rank FROM kept""",
    "csv_roundtrip": f"WITH {_PLAYS} SELECT * FROM plays",
    "csv_users": 'SELECT c_custkey::BIGINT AS user_id, c_name AS "Username" FROM customer',
    "csv_songs": "SELECT p_partkey::BIGINT AS song_id, p_name AS title, p_brand AS artist_name FROM part",
    "csv_faults": f"""WITH {_PLAYS} SELECT 0::BIGINT AS user_id, 0::BIGINT AS song_id,
        count(*) FILTER (song_id % 11 = 0) AS play_count FROM plays""",
    "als_top_items_shape": f"""WITH {_TRAINED} SELECT DISTINCT user_id::INT AS user_id, 10::BIGINT AS n_songs,
        1 AS first_rank, 10 AS last_rank FROM trained""",
    "als_top_items_scores": f"""WITH {_TRAINED}, ranks AS (SELECT unnest(range(1, 11))::INT AS rank)
        SELECT DISTINCT user_id::INT AS user_id, rank, true AS same FROM trained, ranks""",
    "sinks_roundtrip": f"""WITH {_RANKED} SELECT sink, user_id, rank, song_id, play_count, title, artist_name
        FROM ranked LEFT JOIN (SELECT * FROM songs JOIN part ON p_partkey = song_id WHERE p_size <= 25) USING (song_id)
        CROSS JOIN (VALUES ('parquet'), ('orc'), ('json'), ('csv')) AS sinks(sink) WHERE rank <= 10""",
    "input_presence": """SELECT 'orders' AS name, true AS required, true AS present, count(*) AS n_rows FROM orders
        UNION ALL SELECT 'lineitem', true, true, count(*) FROM lineitem
        UNION ALL SELECT 'users', false, true, count(*) FROM customer
        UNION ALL SELECT 'songs', false, true, count(*) FROM part
        UNION ALL SELECT 'titles', false, false, 0 UNION ALL SELECT 'none', false, false, 0""",
    "als_checkpointed": f"WITH {_TRAINED} SELECT DISTINCT user_id, true AS same FROM trained",
    "model_roundtrip": f"WITH {_TRAINED} SELECT DISTINCT user_id, true AS same FROM trained",
    "model_describe": f"""WITH {_TRAINED} SELECT {FIT['rank']} AS rank,
        count(DISTINCT user_id) AS users, count(DISTINCT song_id) AS items FROM trained""",
    "model_users": f"""WITH {_TRAINED} SELECT DISTINCT user_id FROM plays
        WHERE user_id NOT IN (SELECT user_id FROM trained)""",
}
