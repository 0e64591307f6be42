import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.operators import factorize, fold_in


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    import workload

    return workload.fitted(spark, sf_dir), workload.training_rows(spark, sf_dir)


def collected(df):
    return {r.id: np.array(r.features) for r in df.collect()}


@pytest.mark.parametrize("rows_per_task", [fold_in.ROWS_PER_TASK, 7])
def test_known_users_get_their_own_vector(trained, rows_per_task):
    model, rows = trained
    got = collected(fold_in.fold_in(rows, factorize.item_vectors(model), rows_per_task=rows_per_task))
    want = collected(factorize.user_vectors(model))
    assert got.keys() == want.keys()
    assert max(np.abs(got[i] - want[i]).max() for i in got) < 1e-3


def test_without_the_sign_the_normal_equations_hold(spark):
    rng = np.random.default_rng(1)
    items = {i: rng.standard_normal(5) for i in range(30)}
    ratings = [(u, int(i), float(rng.random() * 3 - 0.5)) for u in range(6) for i in rng.choice(30, 9)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in items.items()], "id int, features array<double>")
    got = collected(fold_in.fold_in(
        spark.createDataFrame(ratings, "u long, i long, r double"), table, reg=0.3, alpha=2.0, nonnegative=False, user="u", item="i", rating="r"
    ))
    shared = sum(np.outer(v, v) for v in items.values())
    for u in range(6):
        own = [(items[i], r) for w, i, r in ratings if w == u]
        a = shared + sum(2 * abs(r) * np.outer(y, y) for y, r in own) + 0.3 * sum(r > 0 for _, r in own) * np.eye(5)
        b = sum((1 + 2 * r) * y for y, r in own if r > 0)
        assert np.allclose(got[u], np.linalg.solve(a, b), atol=1e-5)


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None)], "id long, features array<float>")
    ratings = [(1, 1, 1.0), (2, 9, 1.0), (None, 1, 1.0), (3, None, 1.0), (4, 1, None), (5, 2, 0.0), (6, 3, 1.0), (7, 2, 1.0), (7, 2, 1.0)]
    df = spark.createDataFrame(ratings, "user_id long, song_id long, rating_log double")
    got = collected(fold_in.fold_in(df, items))
    assert set(got) == {1, 5, 7} and got[5].tolist() == [0, 0] and got[1][0] > 0 and got[7][1] > 0
    assert fold_in.fold_in(df.limit(0), items).count() == 0
    assert fold_in.fold_in(df, items.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10_000))
def test_least_squares_without_negative_entries(n, seed):
    rng = np.random.default_rng(seed)
    half = rng.standard_normal((n + 2, n))
    a, b = half.T @ half + 0.01 * np.eye(n), rng.standard_normal(n) * 3
    x = fold_in.non_negative(a, b)
    slope = a @ x - b
    assert (x >= 0).all() and (slope > -1e-6).all() and abs(slope @ x) < 1e-6


def test_gram_matrix(spark):
    rng = np.random.default_rng(3)
    y = rng.standard_normal((200, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "id long, features array<double>")
    assert np.allclose(fold_in.gram(df.repartition(9)), y.T @ y)


def test_many_users_in_one_call(spark, monkeypatch):
    rng = np.random.default_rng(4)
    half = rng.standard_normal((50, 7, 5))
    a, b = np.einsum("nij,nik->njk", half, half) + 0.01 * np.eye(5), rng.standard_normal((50, 5)) * 3
    assert np.allclose(fold_in.non_negative_each(a, b), [fold_in.non_negative(*p) for p in zip(a, b)])
    items = spark.createDataFrame([(i, rng.random(5).tolist()) for i in range(40)], "id long, features array<double>")
    rows = [(u, int(i), float(rng.random())) for u in range(300) for i in rng.choice(40, 1 + u % 20)]
    df = spark.createDataFrame(rows, "user_id long, song_id long, rating_log double").coalesce(1)
    calls = []
    monkeypatch.setattr(type(df.groupBy()), "applyInArrow", lambda self, f, s, real=type(df.groupBy()).applyInArrow: (calls.append(s), real(self, f, s))[1])
    want = collected(fold_in.fold_in(df, items))
    # No call per user; the one there is adds up the Gram matrix.
    assert len(calls) == 1 and want.keys() == set(range(300))
    for products, width in ((60, 24), (1 << 21, 2)):
        monkeypatch.setattr(fold_in, "PRODUCTS", products)
        monkeypatch.setattr(fold_in, "MAX_WIDTH", width)
        for slices in (fold_in.ROWS_PER_TASK, 7):
            got = collected(fold_in.fold_in(df, items, rows_per_task=slices))
            assert got.keys() == want.keys() and max(np.abs(got[i] - want[i]).max() for i in got) < 1e-5
