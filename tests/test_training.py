import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.operators import evaluate, factorize, interactions, recommend, split
from earshot.plans import training
from earshot.sources import models, storage

REG, ALPHA = 0.1, 2.0


@pytest.fixture(scope="module")
def ratings(plays):
    return interactions.clean(plays, 30, 25).cache()


@pytest.fixture(scope="module", params=[True, False])
def fitted(request, ratings):
    model = factorize.train(
        ratings, seed=1, rank=6, iterations=6, reg=REG, alpha=ALPHA, nonnegative=request.param
    )
    return request.param, model


def table(df):
    return {r.id: np.array(r.features, np.float64) for r in df.collect()}


def test_user_vectors_solve_the_normal_equations(ratings, fitted):
    nonnegative, model = fitted
    users, items = table(factorize.user_vectors(model)), table(factorize.item_vectors(model))
    gram = sum(np.outer(y, y) for y in items.values())
    left = {u: gram.copy() for u in users}
    right = {u: np.zeros(6) for u in users}
    for r in ratings.collect():
        y, c = items[r.song_id], ALPHA * r.rating_log
        left[r.user_id] += c * np.outer(y, y) + REG * np.eye(6)
        right[r.user_id] += (1 + c) * y
    for u, x in users.items():
        slope = left[u] @ x - right[u]
        scale = np.abs(right[u]).max()
        if nonnegative:
            assert (x >= 0).all()
            assert (slope >= -1e-4 * scale).all()
            assert np.abs(slope * x).max() < 1e-4 * scale
        else:
            assert np.abs(slope).max() < 1e-4 * scale


def test_top_items_equal_brute_force(spark, fitted):
    _, model = fitted
    users, items = table(factorize.user_vectors(model)), table(factorize.item_vectors(model))
    ids = sorted(items)
    recs = {r.user_id: r.recommendations for r in recommend.top_items(model, 4).collect()}
    assert recs.keys() == users.keys()
    for u, x in users.items():
        best = sorted((float(x @ items[i]) for i in ids), reverse=True)[:4]
        assert [r.rating for r in recs[u]] == pytest.approx(best, abs=1e-5)
        assert [float(x @ items[r.song_id]) for r in recs[u]] == pytest.approx(best, abs=1e-5)
    some = spark.createDataFrame([(u,) for u in list(users)[:3]] + [(10**6,)], "user_id long")
    assert {r.user_id for r in recommend.top_items(model, 4, some).collect()} == set(list(users)[:3])


def test_recommendation_shapes(fitted):
    recs = recommend.top_items(fitted[1], 3)
    listed = recommend.predictions(recs).head()
    assert len(listed.prediction) == 3 and isinstance(listed.prediction[0], float)
    ranked = recommend.ranked_items(recs).filter(F.col("user_id") == listed.user_id).orderBy("rank")
    assert [float(r.song_id) for r in ranked.collect()] == listed.prediction
    assert [r.rank for r in ranked.collect()] == [1, 2, 3]


def test_same_seed_same_factors(ratings):
    first, second, other = (
        table(factorize.train(ratings, seed=s, rank=3, iterations=2).userFactors) for s in (5, 5, 6)
    )
    assert max(np.abs(first[u] - second[u]).max() for u in first) < 1e-5
    assert max(np.abs(first[u] - other[u]).max() for u in first) > 1e-5


def test_untrainable_rows_are_named(spark):
    df = spark.createDataFrame([(2**40, 1, 1.0)], "user_id long, song_id long, rating_log double")
    with pytest.raises(ValueError, match="unusable_ids=1"):
        factorize.train(df, seed=1)


def test_blocks_follow_data_and_cores():
    assert factorize.block_count(0, 8) == 1
    assert factorize.block_count(60_000, 8) == 3
    assert factorize.block_count(600_000, 8) == 8
    assert factorize.block_count(100_000_000, 8) == 50
    assert factorize.block_count(10**12, 8000) == 500_000


def test_short_vectors_need_fewer_blocks(ratings, monkeypatch):
    # 60 and 360 times sf0.1: no more blocks than cores, so that a vector is not sent more often.
    assert factorize.block_count(22_138_656, 12, 8) == 12
    assert factorize.block_count(6 * 22_138_656, 12, 8) == 12
    assert factorize.block_count(10**9, 12, 8) == 70
    assert factorize.block_count(100_000_000, 8, 300) == factorize.block_count(100_000_000, 8, 150) == 50
    n = ratings.count()
    monkeypatch.setattr(factorize, "MAX_RATINGS_PER_BLOCK", n // 40)
    monkeypatch.setattr(factorize, "MIN_RATINGS_PER_BLOCK", n // 2)
    model = factorize.train(ratings, seed=1, rank=8, iterations=1)
    assert model.userFactors.rdd.getNumPartitions() < 40 // 4


def test_save_load_describe(spark, fitted):
    _, model = fitted
    path = storage.fresh_path(spark, "test-model")
    models.save(model, path)
    again = models.load(path)
    before, after = table(model.userFactors), table(again.userFactors)
    assert before.keys() == after.keys()
    assert all((before[u] == after[u]).all() for u in before)
    assert tuple(models.describe(again).head()) == (6, len(before), model.itemFactors.count())
    with pytest.raises(Exception, match="already exists"):
        models.save(model, path)
    models.save(model, path, overwrite=True)


def test_grid_search_keeps_the_best(ratings):
    train, test = split.hash_split(ratings)
    result = training.grid_search(
        train, test, seed=1, ranks=(2, 4), regs=(0.1, 1.0), alphas=(1.0,), iterations=(2,)
    )
    rows = result.metrics.collect()
    assert [(r["rank"], r.reg) for r in rows] == [(2, 0.1), (2, 1.0), (4, 0.1), (4, 1.0)]
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].ndcg == max(r.ndcg for r in rows) == result.best_ndcg
    assert result.best.rank == best[0]["rank"] == result.best_params["rank"]
    assert set(result.best_params) == {"rank", "reg", "alpha", "iterations"}
    # The best score is the one MLlib's evaluator gives.
    listed = recommend.predictions(recommend.top_items(result.best, 10))
    frame = evaluate.eval_frame(listed, evaluate.ground_truth(test))
    assert evaluate.ndcg_evaluator(10).evaluate(frame) == pytest.approx(result.best_ndcg, abs=1e-9)


def test_grid_search_when_every_score_is_zero(spark, ratings):
    user = ratings.head().user_id
    test = spark.createDataFrame([(user, 10**6)], "user_id long, song_id long")
    result = training.grid_search(ratings, test, seed=1, ranks=(2, 3), iterations=(1,))
    assert result.best is not None and result.best.rank == 2
    assert [r.ndcg for r in result.metrics.collect()] == [0.0, 0.0]


def test_train_and_save(spark, plays):
    path = storage.fresh_path(spark, "pipeline")
    result = training.train_and_save(
        plays, path, seed=3, min_user=30, min_item=25, ranks=(3,), iterations=(2,)
    )
    assert models.load(path).rank == 3
    assert result.metrics.count() == 1
    report = result.report.head()
    assert (report.rows_before, report.rows_after) == (6000, 4641)
    assert report.train_rows + report.test_rows == 4641


def test_concurrent_fits_give_the_same_table(ratings):
    train, test = split.hash_split(ratings)
    grid = {"seed": 3, "ranks": (2, 3), "regs": (0.1, 0.5), "iterations": (1,), "k": 5, "blocks": 2}
    one = training.grid_search(train, test, parallelism=1, **grid)
    three = training.grid_search(train, test, parallelism=3, **grid)
    a, b = (sorted((*r[:5], round(r.ndcg, 6), r.is_best) for r in x.metrics.collect()) for x in (one, three))
    assert a == b and one.best_params == three.best_params and sum(r[-1] for r in a) == 1


def test_equal_scores_keep_the_first_whichever_ends_first():
    class Spark:
        class sparkContext:
            setJobGroup = staticmethod(lambda *a, **b: None)

    import time

    def slow_first(i):
        time.sleep(0.5 if i == 0 else 0.0)
        return i

    # The order of the ends is not that of the grid.
    import earshot.plans.training as plan

    plan_target, plan.inheritable_thread_target = plan.inheritable_thread_target, lambda spark: lambda f: f
    try:
        ends = list(plan._together(Spark, slow_first, 4, 2))
    finally:
        plan.inheritable_thread_target = plan_target
    assert sorted(ends) == [0, 1, 2, 3] and ends[0] != 0


def test_a_failing_fit_cancels_the_others(spark):
    import time

    from pyspark.sql import functions as F

    def one(i):
        if i == 0:
            time.sleep(2)
            raise ValueError("no such rank")
        # Would run for minutes.
        slow = F.udf(lambda x: time.sleep(0.05) or x, "long")
        return spark.range(0, 100_000, 1, 8).select(F.sum(slow("id"))).collect()

    began = time.time()
    with pytest.raises(ValueError, match="no such rank"):
        list(training._together(spark, one, 3, 2))
    assert time.time() - began < 60
