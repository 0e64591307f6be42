import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from earshot.operators import interactions, skew, split

SCHEMA = "user_id long, song_id long, play_count int"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def brute_clean(rows, min_user, min_item):
    users = Counter(r[0] for r in rows if r[0] is not None)
    songs = Counter(r[1] for r in rows if r[1] is not None)
    return Counter(
        (*r, users[r[0]], songs[r[1]])
        for r in rows
        if users[r[0]] >= min_user and songs[r[1]] >= min_item
    )


@pytest.mark.parametrize(
    "limits",
    [{}, *({"max_broadcast_keys": 0, "rows_per_slice": n} for n in (1, 7, 1000)), {"max_broadcast_keys": 41, "rows_per_slice": 3}],
)
def test_support_filter_with_hot_keys_and_copies(spark, limits):
    rows = [(0, 0, 3)] * 200 + [(0, s, 1) for s in range(50)] + [(u, 1, u) for u in range(40)]
    rows += [(u, s, 2) for u in range(5) for s in range(u + 3)] + [(None, 1, 1), (1, None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = interactions.support_filter(df, 5, 4, **limits)
    assert got.columns == ["user_id", "song_id", "play_count", "user_n", "song_n"]
    assert rows_of(got) == brute_clean(rows, 5, 4)


def test_support_filter_keeps_id_types(spark):
    df = spark.createDataFrame([(1, 7, 2)] * 3 + [(2, 7, 1)], "user_id int, song_id long, play_count int")
    got = interactions.support_filter(df, 2, 2)
    assert dict(got.dtypes)["user_id"] == "int" and dict(got.dtypes)["song_id"] == "bigint"
    assert rows_of(got) == Counter({(1, 7, 2, 3, 4): 3})


def test_support_is_counted_once_on_the_table_as_given(spark, plays):
    rows = [tuple(r) for r in plays.collect()]
    assert rows_of(interactions.support_filter(plays, 30, 25)) == brute_clean(rows, 30, 25)
    assert sum(brute_clean(rows, 30, 25).values()) == 4641


def test_copies_of_one_row_spread_over_slices(spark):
    df = spark.range(0, 20_000, 1, 20).select(
        F.lit(0).cast("long").alias("user_id"), F.lit(1).cast("long").alias("song_id"), F.lit(1).alias("play_count")
    )
    counts = interactions.support_counts(df, "user_id", "user_n")
    assert [tuple(r) for r in skew.hot_keys(counts, ["user_id"], "user_n", 1000).collect()] == [(0, 20)]
    joined = skew.attach_counts(df, counts, "user_id", "user_n", 1, 1000, max_broadcast_keys=0)
    per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 20_000
    assert len(per_task) > 1


def test_few_counts_are_broadcast(spark, plays):
    def plan(**limits):
        cleaned = interactions.support_filter(plays, 30, 25, **limits)
        return cleaned._jdf.queryExecution().optimizedPlan().toString()

    assert plan().count("strategy=broadcast") == 2
    assert plan(max_broadcast_keys=180).count("strategy=broadcast") >= 1
    assert "SPARK_PARTITION_ID" in plan(max_broadcast_keys=0)


def test_log_rating_edges(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 9)], SCHEMA)
    assert [r.rating_log for r in interactions.log_rating(df).collect()] == [0.0, math.log(10)]


def test_cleaning_report(spark, plays):
    cleaned = interactions.clean(plays, 30, 25)
    tagged = split.hash_tag(cleaned)
    row = interactions.cleaning_report(plays, tagged).head()
    assert (row.rows_before, row.rows_after) == (6000, 4641)
    assert row.train_rows + row.test_rows == 4641
    assert row.test_users == tagged.filter("NOT is_train").select("user_id").distinct().count()


def test_lookup_keeps_rows_and_fills_missing(spark):
    facts = spark.createDataFrame([(u, u % 3) for u in range(60)] + [(99, None)], "user_id long, k long")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "k long, name string")
    want = Counter((u, u % 3, {0: "a", 1: "b"}.get(u % 3)) for u in range(60)) + Counter([(99, None, None)])
    for limit in (skew.MAX_BROADCAST_NAMES, 0):
        got = Counter((r.user_id, r.k, r.name) for r in skew.lookup(facts, names, "k", limit).collect())
        assert got == want


def test_no_hot_key_is_left_whole(spark):
    counts = spark.range(50).select(F.col("id").alias("k"), (F.col("id") + 1).alias("n"))
    for limit in (10**6, 3):
        hot = skew.hot_keys(counts, ["k"], "n", 10, max_broadcast_keys=limit)
        assert {r.k: r._slices for r in hot.collect()} == {k: -(-(k + 1) // 10) for k in range(10, 50)}


def test_hash_split_sends_equal_pairs_to_one_side(spark, plays):
    train, test = split.hash_split(plays)
    assert train.count() + test.count() == plays.count()
    pair = ["user_id", "song_id"]
    assert train.select(pair).intersect(test.select(pair)).count() == 0


def test_random_split_is_whole_and_repeatable(spark, plays):
    train, test = split.random_split(plays, 7)
    assert rows_of(train.unionByName(test)) == rows_of(plays)
    assert 0.75 < train.count() / plays.count() < 0.85
    again, _ = split.random_split(plays, 7)
    assert rows_of(again) == rows_of(train)
    other, _ = split.random_split(plays, 8)
    assert rows_of(other) != rows_of(train)
    # However the rows are stored.
    for n in (3, 5):
        assert rows_of(split.random_split(plays.repartition(n), 7)[0]) == rows_of(train)


def test_random_split_draws_every_copy(spark, monkeypatch):
    monkeypatch.setattr(split, "COPIES_PER_STEP", 64)
    df = spark.createDataFrame([(1, 2, 3)] * 1000 + [(None, None, None)] * 3, SCHEMA)
    train, test = split.random_split(df, 1)
    assert train.count() + test.count() == 1003
    assert 700 < train.filter("user_id = 1").count() < 900
