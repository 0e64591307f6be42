import pytest
from pyspark.sql import functions as F

from earshot.operators import interactions, profiles, skew, sketches
from earshot.sources import storage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    import workload

    return interactions.by_user(workload.plays(spark, sf_dir))


def test_what_is_asked_by_user_needs_no_shuffle(kept, plays):
    asked = {
        "counts": lambda df: interactions.support_counts(df, "user_id", "user_n"),
        "totals": lambda df: profiles.user_stats(df, distinct=False),
        "stats": lambda df: profiles.user_stats(df),
        "history": lambda df: profiles.history(df, n=10).drop("title", "artist_name"),
    }
    for name, ask in asked.items():
        got, want = ask(kept), ask(plays)
        assert "Exchange" not in plan(got), name
        assert "Exchange" in plan(want), name
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_hot_user_is_not_put_into_one_bucket(spark):
    rows = spark.range(1000).select((F.col("id") % 3 % 2).alias("user_id"), F.col("id").alias("song_id"), F.lit(1).alias("play_count"))
    table = interactions.by_user(rows, rows_per_slice=500)
    assert table.count() == 1000 and "Exchange" in plan(profiles.user_stats(table))
    assert interactions.by_user(rows.limit(0)).count() == 0


def test_sketches_of_days_are_merged(spark):
    rows = spark.range(30_000).select((F.col("id") % 5).alias("user_id"), (F.col("id") % 7).alias("day"), (F.col("id") % 11_000).alias("song_id"))
    by_day = sketches.sketched(rows.unionByName(rows), "user_id", "day")
    merged = {r.user_id: r.distinct_songs for r in sketches.estimated(sketches.merged(by_day, "user_id")).collect()}
    whole = {r.user_id: r.distinct_songs for r in sketches.estimated(sketches.sketched(rows, "user_id")).collect()}
    exact = {r.user_id: r.n for r in rows.groupBy("user_id").agg(F.countDistinct("song_id").alias("n")).collect()}
    assert merged.keys() == whole.keys() == exact.keys()
    for u, n in exact.items():
        assert abs(merged[u] - n) <= 4 * sketches.relative_error() * n and abs(whole[u] - n) <= 4 * sketches.relative_error() * n
    odd = spark.createDataFrame([(1, None), (1, None), (2, 5), (None, 5)], "user_id long, song_id long")
    assert {(r.user_id, r.distinct_songs) for r in sketches.estimated(sketches.sketched(odd, "user_id")).collect()} == {(1, 0), (2, 1), (None, 1)}


def test_small_tables_are_told_by_rows_and_bytes(spark):
    names = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "k long, name string")
    assert storage.is_small(names, 50) and not storage.is_small(names, 49) and not storage.is_small(names, 50, 50_000)
    assert storage.is_small(names.limit(0), 0)
    facts = spark.range(100).select((F.col("id") % 60).alias("k"))
    for limit in (storage.MAX_BROADCAST_BYTES, 10):
        got = skew.lookup(facts, names, "k", max_broadcast_bytes=limit)
        assert ("SortMergeJoin" in plan(got)) == (limit == 10)
        assert got.filter("name is null").count() == facts.filter("k >= 50").count()


def test_buckets_stay_small(spark):
    rows = spark.range(3_500_000).select((F.col("id") % 90_000).alias("user_id"), (F.col("id") % 77).alias("song_id"), F.lit(1).alias("play_count"))
    cores = spark.sparkContext.defaultParallelism
    table = interactions.by_user(rows.unionByName(rows).unionByName(rows))
    assert len(table.inputFiles()) == max(cores, 21)


def test_many_rows_are_ranked_in_more_partitions(spark, plays, monkeypatch):
    from earshot.operators import ranking

    want = ranking.rank_all(plays, "user_id", "song_id", "play_count")
    monkeypatch.setattr(ranking, "ROWS_PER_PARTITION", 100)
    got = ranking.rank_all(plays, "user_id", "song_id", "play_count")
    assert got.rdd.getNumPartitions() == -(-plays.count() // 100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_pieces_of_a_layout_grow_with_the_rows(spark, sf_dir, monkeypatch):
    import workload

    dealt = []
    real = type(spark.range(1)).repartition
    monkeypatch.setattr(type(spark.range(1)), "repartition", lambda self, n, *c: (dealt.append(n), real(self, n, *c))[1])
    assert workload.random_split_again(spark, sf_dir).filter("not same").count() == 0
    monkeypatch.setattr(workload, "ROWS_PER_PIECE", 100)
    assert workload.random_split_again(spark, sf_dir).filter("not same").count() == 0
    assert dealt[0] == 5 and 3 in dealt and max(dealt) == -(-workload.cleaned(spark, sf_dir).count() // 100) > 8
