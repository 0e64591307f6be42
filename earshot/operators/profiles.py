"""What users listened to: totals, histories, lookups by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions import columns
from earshot.operators import ranking, skew
from earshot.sources import schemas, storage


def for_users(
    df: DataFrame,
    ids: DataFrame,
    user: str = "user_id",
    max_broadcast_keys: int = skew.MAX_BROADCAST_KEYS,
    rows_per_slice: int = skew.ROWS_PER_SLICE,
) -> DataFrame:
    """Rows of the requested users; ``ids`` has a column of the same name.

    Counts the ids when called. Up to ``max_broadcast_keys`` they are broadcast and no row
    moves; beyond, a Bloom filter of the ids drops other users' rows before the shuffle, the
    rows are counted per requested user, and those of a hot one are cut into slices.
    """
    wanted = ids.select(user).filter(F.col(user).isNotNull())
    if wanted.count() <= max_broadcast_keys:
        return df.join(F.broadcast(wanted.distinct()), user, "left_semi")
    # Many rows may still be few ids.
    wanted = storage.written(wanted.distinct(), "wanted")
    n = wanted.count()
    if n <= max_broadcast_keys:
        return df.join(F.broadcast(wanted), user, "left_semi")
    # Rows of other users are dropped where they lie, but for a few; the join drops those.
    df = skew.pre_filtered(df, wanted, user, n)
    counts = df.groupBy(user).agg(F.count("*").alias("_user_rows")).join(wanted, user, "left_semi")
    counts = storage.written(counts, "wanted-counts")
    kept = skew.attach_counts(df, counts, user, "_user_rows", n, rows_per_slice, max_broadcast_keys)
    return kept.select(*df.columns)


def unknown_users(ids: DataFrame, known: DataFrame, user: str = "user_id") -> DataFrame:
    """Requested ids that ``known`` does not hold.

    ``known`` may be the whole interaction table: its ids are made distinct in
    each partition before they are shuffled.
    """
    return ids.select(user).distinct().join(known.select(user).distinct(), user, "left_anti")


def user_stats(
    df: DataFrame,
    ids: DataFrame | None = None,
    digits: int | None = None,
    distinct: bool = True,
    user: str = "user_id",
    item: str = "song_id",
    plays: str = "play_count",
) -> DataFrame:
    """Totals per user. With ``ids``: a row for each id, 0, 0, 0 and NULL for an unknown one.

    ``distinct_songs`` needs all (user, song) pairs to be shuffled; without it only
    one partial row per user and partition is.
    """
    rows = df.filter(F.col(user).isNotNull())
    if ids is not None:
        ids = ids.select(user).filter(F.col(user).isNotNull()).distinct()
        rows = for_users(rows, ids, user)
    stats = rows.groupBy(user).agg(
        F.count(item).alias("total_songs"),
        *([F.countDistinct(item).alias("distinct_songs")] if distinct else []),
        F.coalesce(F.sum(plays), F.lit(0)).alias("total_plays"),
        columns.rounded(F.avg(plays), digits).alias("avg_plays"),
    )
    if ids is None:
        return stats
    return ids.join(stats, user, "left").fillna(0, [c for c in stats.columns if c.startswith(("total", "distinct"))])


def history(
    df: DataFrame,
    songs: DataFrame | None = None,
    n: int | None = 50,
    ids: DataFrame | None = None,
    display: bool = False,
    user: str = "user_id",
    item: str = "song_id",
    plays: str = "play_count",
) -> DataFrame:
    """Each user's most played songs, best first; ``n`` of 0 or ``None`` keeps them all.

    Titles are joined after the cut. ``display`` shortens texts and fills in the
    missing ones. The columns are the same with and without a song dimension.
    """
    rows = df.filter(F.col(user).isNotNull()).select(user, item, plays)
    if ids is not None:
        rows = for_users(rows, ids, user)
    ranked = ranking.top_n(rows, user, item, plays, n) if n else ranking.rank_all(rows, user, item, plays)
    if songs is None:
        text = F.lit(None).cast(T.StringType())
        named = ranked.withColumn("title", text).withColumn("artist_name", text)
    else:
        unique = schemas.one_per_key(songs.select(item, "title", "artist_name"), item)
        named = skew.lookup(ranked, unique, item)
    title, artist, count = F.col("title"), F.col("artist_name"), F.col(plays)
    if display:
        count = F.coalesce(count, F.lit(0))
        title = columns.display_text(title, columns.UNKNOWN_TITLE)
        artist = columns.display_text(artist, columns.UNKNOWN_ARTIST)
    return named.select(
        user, "rank", item, count.alias(plays), title.alias("title"), artist.alias("artist_name")
    )


def history_totals(
    df: DataFrame,
    n: int | None = 50,
    ids: DataFrame | None = None,
    user: str = "user_id",
    item: str = "song_id",
    plays: str = "play_count",
) -> DataFrame:
    """Songs shown and plays shown per user, over the rows :func:`history` returns."""
    rows = df.filter(F.col(user).isNotNull()).select(user, item, plays)
    if ids is not None:
        rows = for_users(rows, ids, user)
    shown = ranking.top_n(rows, user, item, plays, n) if n else rows
    return shown.groupBy(user).agg(
        F.count("*").alias("songs_shown"), F.coalesce(F.sum(plays), F.lit(0)).alias("plays_shown")
    )
