from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.operators import profiles, ranking

PLAYS = "user_id long, song_id long, play_count int"
SONGS = "song_id long, title string, artist_name string"


def brute_ranks(rows):
    by_user = defaultdict(list)
    for user, song, plays in rows:
        if user is not None:
            by_user[user].append((user, song, plays))

    def order(row):
        _, song, plays = row
        return (plays is None, -(plays or 0), song is not None, song or 0)

    return Counter(
        (*row, i) for own in by_user.values() for i, row in enumerate(sorted(own, key=order), start=1)
    )


def ranks_of(df):
    return Counter((r.user_id, r.song_id, r.play_count, r.rank) for r in df.collect())


ROWS = (
    [(0, s, s % 7) for s in range(300)]
    + [(0, 5, 6)] * 120
    + [(1, 70_000 * s, 3) for s in range(-20, 20)]
    + [(1, 2**40 + s, 3) for s in range(30)]
    + [(2, 1, None), (2, None, 4), (2, 9, 4), (None, 1, 1)]
)


@pytest.mark.parametrize("rows_per_task", [1, 100, 10_000])
def test_rank_all_equals_sorting(spark, rows_per_task):
    df = spark.createDataFrame(ROWS, PLAYS).repartition(4)
    got = ranks_of(ranking.rank_all(df, "user_id", "song_id", "play_count", rows_per_task))
    assert got == brute_ranks(ROWS)


def test_rank_all_takes_int_ids(spark):
    rows = [(u, s, (u * s) % 5) for u in range(2) for s in range(-40, 40)]
    df = spark.createDataFrame(rows, "user_id int, song_id int, play_count int")
    assert ranks_of(ranking.rank_all(df, "user_id", "song_id", "play_count", 1)) == brute_ranks(rows)


@pytest.mark.parametrize("rows_per_task", [10, 10_000])
def test_rank_all_keeps_columns_and_any_ordered_type(spark, rows_per_task):
    rows = [("u", f"s{i % 30}", 5 - (i % 40) / 8, f"extra {i}") for i in range(200)] + [("v", "s1", None, None)]
    df = spark.createDataFrame(rows, "user_id string, song_id string, play_count double, extra string").repartition(3)
    out = ranking.rank_all(df, "user_id", "song_id", "play_count", rows_per_task)
    assert out.columns == [*df.columns, "rank"]
    got = sorted(out.collect(), key=lambda r: (r.user_id, r["rank"]))
    assert [r["rank"] for r in got] == [*range(1, 201), 1]
    assert sorted(tuple(r)[:4] for r in got[:200]) == sorted(rows[:200])
    keys = [(-r.play_count, r.song_id) for r in got[:200]]
    assert keys == sorted(keys)


def test_top_n_has_one_schema(spark):
    df = spark.createDataFrame([(0, 1, 5, "x"), (0, 2, 6, "y")], PLAYS + ", extra string")
    few, many = (ranking.top_n(df, "user_id", "song_id", "play_count", n) for n in (5, 1001))
    assert few.columns == many.columns == [*df.columns, "rank"]
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


@pytest.mark.parametrize("n", [1, 10, 2000])
def test_top_n_on_either_side_of_the_threshold(spark, n):
    df = spark.createDataFrame(ROWS, PLAYS)
    want = Counter({k: c for k, c in brute_ranks(ROWS).items() if k[3] <= n})
    assert ranks_of(ranking.top_n(df, "user_id", "song_id", "play_count", n)) == want


@pytest.mark.parametrize("n", [0, None])
def test_history_without_limit_keeps_all_rows(spark, n):
    df = spark.createDataFrame(ROWS, PLAYS)
    assert ranks_of(profiles.history(df, n=n)) == brute_ranks(ROWS)


def test_history_texts(spark):
    df = spark.createDataFrame([(0, s, 10 - s) for s in range(5)], PLAYS)
    songs = spark.createDataFrame(
        [(0, "x" * 40, "y" * 40), (1, "", None), (2, None, ""), (3, " ", "né")], SONGS
    )
    shown = [(r.title, r.artist_name) for r in profiles.history(df, songs, display=True).orderBy("rank").collect()]
    assert shown == [
        ("x" * 33, "y" * 33), ("Desconocida", "Desconocido"), ("Desconocida", "Desconocido"),
        (" ", "né"), ("Desconocida", "Desconocido"),
    ]
    plain = [(r.title, r.artist_name) for r in profiles.history(df, songs).orderBy("rank").collect()]
    assert plain[0] == ("x" * 40, "y" * 40) and plain[4] == (None, None)


def test_history_has_one_schema(spark):
    df = spark.createDataFrame([(0, 1, 1)], PLAYS)
    songs = spark.createDataFrame([(1, "a", "b"), (1, "c", "d")], SONGS)
    with_songs, without = profiles.history(df, songs), profiles.history(df)
    assert [(f.name, f.dataType) for f in with_songs.schema] == [(f.name, f.dataType) for f in without.schema]
    # A repeated song does not multiply the history.
    assert [tuple(r) for r in with_songs.collect()] == [(0, 1, 1, 1, "a", "b")]


def test_history_for_requested_ids(spark):
    df = spark.createDataFrame(ROWS, PLAYS)
    ids = spark.createDataFrame([(2,), (2,), (77,)], "user_id long")
    assert ranks_of(profiles.history(df, n=1, ids=ids)) == Counter([(2, None, 4, 1)])


def test_history_totals_follow_the_cut(spark):
    df = spark.createDataFrame([(0, 1, 9), (0, 2, 5), (0, 3, 1), (4, 1, 2)], PLAYS)
    totals = lambda n: {tuple(r) for r in profiles.history_totals(df, n=n).collect()}
    assert totals(2) == {(0, 2, 14), (4, 1, 2)}
    assert totals(None) == {(0, 3, 15), (4, 1, 2)}


def test_stats(spark):
    df = spark.createDataFrame([(0, 1, 2), (0, 1, 3), (0, 2, 6), (3, None, 1), (None, 1, 1)], PLAYS)
    stats = {r.user_id: tuple(r)[1:] for r in profiles.user_stats(df, digits=2).collect()}
    assert stats == {0: (3, 2, 11, 3.67), 3: (0, 0, 1, 1.0)}
    totals = profiles.user_stats(df, spark.createDataFrame([(0,), (9,)], "user_id long"), digits=1, distinct=False)
    assert {tuple(r) for r in totals.collect()} == {(0, 3, 11, 3.7), (9, 0, 0, None)}


def test_stats_of_an_unknown_user(spark):
    df = spark.createDataFrame([(0, 1, 2)], PLAYS)
    ids = spark.createDataFrame([(0,), (99,), (99,)], "user_id long")
    stats = {tuple(r) for r in profiles.user_stats(df, ids).collect()}
    assert stats == {(0, 1, 1, 2, 2.0), (99, 0, 0, 0, None)}


def test_lookups_by_id(spark):
    df = spark.createDataFrame([(0, 1, 2), (0, 1, 2), (1, 1, 1)], PLAYS)
    ids = spark.createDataFrame([(0,), (0,), (99,)], "user_id long")
    assert [tuple(r) for r in profiles.for_users(df, ids).collect()] == [(0, 1, 2)] * 2
    assert [tuple(r) for r in profiles.for_users(df, ids, max_broadcast_keys=0).collect()] == [(0, 1, 2)] * 2
    assert [tuple(r) for r in profiles.unknown_users(ids, df).collect()] == [(99,)]


def test_a_requested_user_with_most_rows_is_cut(spark):
    rows = [(7, i, i % 9) for i in range(5000)] + [(u, 1, 1) for u in range(50) if u != 7]
    df = spark.createDataFrame(rows, PLAYS).repartition(4)
    ids = spark.createDataFrame([(u,) for u in range(0, 60)], "user_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = profiles.for_users(df, ids, max_broadcast_keys=0, rows_per_slice=500)
        tasks = found.filter("user_id = 7").groupBy(F.spark_partition_id()).count().collect()
        assert found.count() == len(rows)
        assert len(tasks) > 2 and sum(r["count"] for r in tasks) == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_filter_of_ids_drops_other_rows_and_keeps_all_of_theirs(spark):
    from earshot.operators import skew

    rows = spark.range(40_000).select((F.col("id") % 20_000).alias("user_id"), F.col("id").alias("song_id"), F.lit("clash").alias("_words"))
    ids = spark.range(0, 20_000, 10).select(F.col("id").cast("int").alias("user_id"))
    left = skew.pre_filtered(rows, ids, "user_id", 2000)
    assert left.columns == rows.columns
    assert left.filter("user_id % 10 = 0").count() == 4000
    assert left.filter("user_id % 10 <> 0").count() < 0.03 * 36_000
    # Too small a filter is of no use, and none is made; an empty one lets nothing pass.
    assert skew.pre_filtered(rows, ids, "user_id", 2000, max_bytes=100) is rows
    assert skew.pre_filtered(rows, ids.limit(0), "user_id", 0).count() == 0
    for limit in (0, 10**6):
        got = profiles.for_users(rows, ids, max_broadcast_keys=limit, rows_per_slice=1)
        assert sorted(got.collect()) == sorted(rows.filter("user_id % 10 = 0").collect())
