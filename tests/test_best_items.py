import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from earshot.operators import best_items, factorize, recommend


def vectors(spark, table):
    rows = [(i, None if v is None else [float(np.float32(x)) for x in v]) for i, v in table]
    return spark.createDataFrame(rows, "id long, features array<float>")


def brute(users, items, k, seen=()):
    """By SQL over all pairs."""
    con = duckdb.connect()
    con.execute("CREATE TABLE u (id BIGINT, f DOUBLE[])")
    con.execute("CREATE TABLE i (id BIGINT, f DOUBLE[])")
    con.execute("CREATE TABLE seen (user_id BIGINT, song_id BIGINT)")
    for name, table in (("u", users), ("i", items)):
        rows = [(n, [float(np.float32(x)) for x in v]) for n, v in table if v is not None]
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    if seen:
        con.executemany("INSERT INTO seen VALUES (?, ?)", list(seen))
    return con.execute(f"""
        SELECT u.id, (row_number() OVER (PARTITION BY u.id ORDER BY list_inner_product(u.f, i.f)::FLOAT DESC, i.id))::INT AS rank, i.id
        FROM u, i WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.id AND s.song_id = i.id)
        QUALIFY rank <= {k} ORDER BY 1, 2""").fetchall()


def told(found):
    return [tuple(r) for r in found.best.select("user_id", "rank", "item_id").orderBy("user_id", "rank").collect()]


def test_small_whole_numbers_with_many_ties(spark):
    rng = np.random.default_rng(1)
    users = [(i, rng.integers(-2, 4, 3)) for i in range(40)] + [(40, np.zeros(3)), (41, None)]
    items = [(i, rng.integers(-2, 4, 3)) for i in range(150)] + [(200 + i, np.zeros(3)) for i in range(60)] + [(999, None)]
    seen = [(int(u), int(i)) for u in range(30) for i in rng.choice(150, 40, replace=False)] * 2 + [(3, 5000), (None, 1), (1, None)]
    args = vectors(spark, users), vectors(spark, items), 7
    assert told(best_items.search(*args, rows_per_block=16)) == brute(users, items, 7)
    pairs = spark.createDataFrame(seen, "user_id long, song_id long")
    assert told(best_items.search(*args, seen=pairs, rows_per_block=16)) == brute(users, items, 7, seen)


def test_users_who_have_seen_nearly_all(spark):
    rng = np.random.default_rng(2)
    users, items = [(i, rng.random(4)) for i in range(6)], [(i, rng.random(4)) for i in range(300)]
    # User 0 has three songs left, user 1 none, user 2 played one song a thousand times.
    seen = [(0, i) for i in range(300) if i not in (7, 120, 299)] + [(1, i) for i in range(300)] + [(2, 5)] * 1000
    pairs = spark.createDataFrame(seen, "user_id long, song_id long")
    found = best_items.search(vectors(spark, users), vectors(spark, items), 10, seen=pairs, rows_per_block=32)
    assert told(found) == brute(users, items, 10, seen)
    lists = {r.user_id: r.recommendations for r in recommend.listed(found.best, found.asked).collect()}
    assert {r.song_id for r in lists[0]} == {7, 120, 299} and lists[1] == [] and len(lists[2]) == 10 and len(lists) == 6


def test_short_blocks_are_skipped_and_change_nothing(spark):
    rng = np.random.default_rng(3)
    users = [(i, rng.random(5)) for i in range(80)]
    items = [(i, rng.random(5) * (4 if i < 40 else 0.3)) for i in range(1200)]
    found = best_items.search(vectors(spark, users), vectors(spark, items), 10, rows_per_block=40)
    assert told(found) == brute(users, items, 10)
    waves = found.report.collect()
    assert sum(w.searched for w in waves) < 0.3 * 80 * 30 and waves[0].searched == 80


def test_requested_users_and_empty_tables(spark):
    rng = np.random.default_rng(4)
    users, items = [(i, rng.random(3)) for i in range(20)], [(i, rng.random(3)) for i in range(50)]
    wanted = spark.createDataFrame([(3,), (3,), (77,)], "user_id long")
    found = best_items.search(vectors(spark, users), vectors(spark, items), 4, users=wanted)
    assert told(found) == brute(users[3:4], items, 4)
    none = vectors(spark, [])
    assert told(best_items.search(none, vectors(spark, items))) == told(best_items.search(vectors(spark, users), none)) == []
    with pytest.raises(ValueError):
        best_items.search(none, none, 0)


def test_trained_factors_against_the_trainer_and_sql(spark, sf_dir):
    import workload

    model = workload.fitted(spark, sf_dir)
    own, other = factorize.user_vectors(model), factorize.item_vectors(model)
    found = best_items.search(own, other, 10, rows_per_block=25)
    want = recommend.ranked_items(recommend.top_items(model, 10)).toPandas().sort_values(["user_id", "rank"])
    got = found.best.toPandas().sort_values(["user_id", "rank"])
    assert (got.user_id.values == want.user_id.values).all() and np.abs(got.score.values - want.score.values).max() < 1e-5
    seen = workload.training_rows(spark, sf_dir).select("user_id", "song_id")
    recs = recommend.top_items(model, 10, exclude_seen=seen)
    assert recs.schema.simpleString() == recommend.top_items(model, 10).schema.simpleString()
    users, items = ([(r.id, r.features) for r in t.collect()] for t in (own, other))
    pairs = {(r.user_id, r.song_id) for r in seen.collect()}
    rows = recommend.ranked_items(recs).select("user_id", "rank", "song_id").orderBy("user_id", "rank").collect()
    assert [tuple(r) for r in rows] == brute(users, items, 10, pairs)
    assert recs.filter(F.size("recommendations") > 10).count() == 0


def test_waves_double():
    assert best_items.waves(0) == [] and best_items.waves(1) == [(0, 1)]
    assert best_items.waves(10) == [(0, 1), (1, 3), (3, 7), (7, 10)]


def test_lists_are_the_trainers_without_computing_all(spark, sf_dir, monkeypatch):
    import workload

    model = workload.fitted(spark, sf_dir)
    theirs = recommend.ranked_items(model.recommendForAllUsers(10)).toPandas().sort_values(["user_id", "rank"])
    some = spark.createDataFrame([(int(theirs.user_id.iloc[0]),), (int(theirs.user_id.iloc[0]),), (10**6,)], "user_id int")
    subset = recommend.ranked_items(model.recommendForUserSubset(some, 3)).toPandas()
    for name in ("recommendForAllUsers", "recommendForUserSubset"):
        monkeypatch.setattr(type(model), name, None)
    ours = recommend.ranked_items(recommend.top_items(model, 10)).toPandas().sort_values(["user_id", "rank"])
    assert (ours[["user_id", "rank"]].values == theirs[["user_id", "rank"]].values).all()
    assert np.abs(ours.score.values - theirs.score.values).max() < 1e-5
    part = recommend.ranked_items(recommend.top_items(model, 3, users=some)).toPandas()
    assert len(part) == len(subset) == 3 and np.allclose(part.score, subset.score, atol=1e-5)


def test_users_and_items_move_once_per_group(spark, monkeypatch):
    rng = np.random.default_rng(6)
    users, items = [(i, rng.random(3)) for i in range(300)], [(i, rng.random(3)) for i in range(2000)]
    moved = []

    def counted(self, *key, real=type(spark.range(1)).groupBy):
        if key == ("user_group", "item_group"):
            moved.append(self.count())
        return real(self, *key)

    monkeypatch.setattr(type(spark.range(1)), "groupBy", counted)
    monkeypatch.setattr(best_items, "GROUPS_PER_CORE", 0.125)
    found = best_items.search(vectors(spark, users), vectors(spark, items), 5, rows_per_block=10)
    assert told(found) == brute(users, items, 5)
    # A wave moves a user once at most, and an item once, though there are 200 blocks.
    assert moved and max(moved[::2]) <= 300 and sum(moved[1::2]) <= 2000
    monkeypatch.setattr(best_items, "MAX_GROUP_BYTES", 56 * 40)
    assert told(best_items.search(vectors(spark, users), vectors(spark, items), 5, rows_per_block=10)) == brute(users, items, 5)


def test_the_first_wave_has_a_sixteenth():
    assert best_items.waves(64) == [(0, 4), (4, 12), (12, 28), (28, 60), (60, 64)]


def test_tiny_scores_prune_as_large_ones(spark):
    rng = np.random.default_rng(7)
    users = [(i, rng.random(5) * 1e-6) for i in range(80)]
    items = [(i, rng.random(5) * (4 if i < 40 else 0.3)) for i in range(1200)]
    found = best_items.search(vectors(spark, users), vectors(spark, items), 10, rows_per_block=40)
    assert told(found) == brute(users, items, 10)
    assert sum(w.searched for w in found.report.collect()) < 0.3 * 80 * 30


def test_a_user_meets_only_the_promising_items_of_a_group():
    rng = np.random.default_rng(8)
    # Everyone likes one kind of song of eight, and all vectors are about as long.
    def table(n):
        features = np.eye(8)[rng.integers(0, 8, n)] * (1 + 0.1 * rng.random((n, 1)))
        return features, {"id": pa.array(np.arange(n)), "features": pa.array(list(features), pa.list_(pa.float64()))}

    own, asking = table(500)
    other, offering = table(8000)
    asking = pa.table({**asking, "last": pa.array(np.full(500, -np.inf))})
    offering = pa.table({**offering, "block": pa.array(np.zeros(8000, np.int32)), "slot": pa.array(np.arange(8000, dtype=np.int32))})
    computed = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            out = np.asarray(self) @ np.asarray(other)
            computed.append(out.size)
            return out

    real = best_items.matrix
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(best_items, "matrix", lambda c: real(c).view(Counted))
        found = best_items._best_of_group(asking, offering, 10).to_pandas()
    found = found.sort_values(["user_id", "score", "item_id"], ascending=[True, False, True])
    scores = (own @ other.T).astype(np.float32)
    want = np.array([np.lexsort((np.arange(8000), -s))[:10] for s in scores])
    assert (found.item_id.values.reshape(500, 10) == want).all()
    assert sum(computed) < 0.25 * scores.size


def test_equal_scores_of_many_items(spark):
    users = [(i, [0.0, 0.0]) for i in range(40)] + [(50, [1.0, 0.0]), (51, [0.0, 1.0])]
    items = [(i, [0.0, float(i % 3)]) for i in range(2000, 0, -1)]
    found = best_items.search(vectors(spark, users), vectors(spark, items), 4)
    assert told(found) == brute(users, items, 4)
    seen = [(0, i) for i in range(1, 1990)] + [(50, 1), (51, 2)]
    found = best_items.search(vectors(spark, users), vectors(spark, items), 4, seen=spark.createDataFrame(seen, "user_id long, song_id long"))
    assert told(found) == brute(users, items, 4, seen)


def test_a_wave_is_dealt_so_that_few_rows_move():
    many_users, even, many_items = (best_items._groups(u, i, 100, 48, 10**9) for u, i in ((10**6, 10**4), (10**5, 10**5), (10**4, 10**6)))
    assert many_users == (48, 1) and even == (8, 6) and many_items[1] == 69
    assert best_items._groups(1000, 1000, 4, 1, 100) == (10, 4)
