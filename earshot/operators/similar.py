"""Users with similar taste: nearest vectors by Euclidean distance, for many users at once."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from earshot.functions import columns
from earshot.functions.nearest import FOUND, Nearest, id_array, matrix
from earshot.functions.regions import Regions, boxes
from earshot.operators import skew
from earshot.sources import schemas, storage

# Query vectors that are collected and broadcast, in bytes; more go through the cells of _by_cells.
MAX_BROADCAST_BYTES = 16 << 20
# Rows that all partitions together may pass on for broadcast queries; with fewer partitions than these they are not counted.
MAX_SENT_ROWS, MAX_PARTITIONS = 100_000_000, 100_000
# Vectors of either side that meet in one group of cells, in bytes: they fit in memory, and their
# comparing takes longer than their moving. A group is made smaller to keep every core busy.
MIN_CELL_BYTES, MAX_CELL_BYTES = 1 << 19, 16 << 20
CELLS_PER_CORE = 4
# Vectors of a sample by which a region is cut, and the share of all pairs above which regions are given up.
SAMPLED_PER_REGION, MAX_VISITED = 64, 0.5
# Vectors with so few entries lie close together in small runs: queries and members of one.
NARROW, NARROW_RUNS = 32, {"query_rows": 64, "member_rows": 128}
# Runs where nearly everything is near: boxes leave out little there, and products of many rows are faster.
WIDE_RUNS = {"query_rows": 512, "member_rows": 1024}

_FOUND = "query_id long, neighbor_id long, dist double"


def fit_index(
    vectors: DataFrame, *, seed: int, tables: int = 5, bucket_length: float = 2.0
) -> BucketedRandomProjectionLSHModel:
    """Random projections for ``id``, ``features``; fit once, use for every search."""
    return BucketedRandomProjectionLSH(
        inputCol="features_vec",
        outputCol="hashes",
        numHashTables=tables,
        bucketLength=bucket_length,
        seed=seed,
    ).fit(_with_vector(vectors))


def _with_vector(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("features_vec", columns.ml_vector("features"))


def signatures(vectors: DataFrame, index: BucketedRandomProjectionLSHModel) -> DataFrame:
    """Adds ``codes``: the bucket of every hash table."""
    hashed = index.transform(_with_vector(vectors))
    codes = [
        vector_to_array(F.col("hashes")[t])[0].cast("long")
        for t in range(index.getNumHashTables())
    ]
    return hashed.select(*vectors.columns, F.array(*codes).alias("codes"))


# A bucket of a fine index: so many to a bucket of the index itself.
_FINE = 1 << 16
# Buckets on either side of its own that a query may probe in a table.
REACH = 4


def _projections(vectors: DataFrame, index: BucketedRandomProjectionLSHModel) -> DataFrame:
    """Adds ``places``: per hash table the projection in units of the bucket length, so that its floor is the bucket."""
    fine = index.copy({index.bucketLength: index.getBucketLength() / _FINE})
    places = F.transform(F.col("codes"), lambda c: c.cast("double") / _FINE)
    return signatures(vectors, fine).select(*vectors.columns, places.alias("places"))


def _perturbed(places: Column, probes: int | Column, reach: int = REACH) -> Column:
    """Per hash table the buckets to look into: the own one, and of all tables' others the ``probes`` nearest.

    How near a bucket is tells the distance from the projection to its edge. All tables have
    lists of one length, filled up with the own bucket.
    """
    steps = [d for r in range(1, reach + 1) for d in (-r, r)]

    def of_table(place: Column, t: Column) -> Column:
        inside = place - F.floor(place)
        return F.array(*[
            F.struct((inside + abs(d) - 1 if d < 0 else F.lit(abs(d)) - inside).alias("gap"), t.alias("t"), F.lit(d).alias("d")) for d in steps
        ])

    ordered = F.array_sort(F.flatten(F.transform(places, of_table)))
    chosen = F.slice(ordered, F.lit(1), F.least(F.lit(probes), F.size(ordered)))

    def buckets(taken: Column) -> Column:
        def one(place: Column, t: Column) -> Column:
            own = F.floor(place)
            steps_taken = F.transform(F.filter(taken, lambda c: c["t"] == t), lambda c: own + c["d"])
            filled = F.concat(F.array(own), steps_taken, F.array_repeat(own, len(steps)))
            return F.slice(filled, 1, 1 + len(steps))

        return F.transform(places, one)

    return F.transform(F.array(chosen), buckets)[0]


def multi_probe(vectors: DataFrame, index: BucketedRandomProjectionLSHModel, probes: int, reach: int = REACH) -> DataFrame:
    """Adds ``codes``, the bucket of every hash table, and ``probes``: per table the buckets a query looks into."""
    placed = _projections(vectors, index)
    codes = F.transform("places", lambda x: F.floor(x))
    return placed.select(*vectors.columns, codes.alias("codes"), _perturbed(F.col("places"), probes, reach).alias("probes"))


@dataclass(frozen=True)
class Calibration:
    """An index, the probes to search it with, the ``recall`` and the share of pairs ``compared`` of the sample.

    ``table`` has both for every bucket length tried.
    """

    index: BucketedRandomProjectionLSHModel
    probes: int
    recall: float
    compared: float
    table: DataFrame


# Queries whose true neighbours a calibration looks at, about so many.
SAMPLE = 300
# Recall beyond the wanted one that the sample must show, as it is only a sample.
MARGIN = 0.02
# Bucket lengths tried, each this many times the one before.
LENGTHS, GROWTH = 14, math.sqrt(2)


def calibrate(
    vectors: DataFrame, *, seed: int, recall: float = 0.9, k: int = 10, tables: int = 5, probes: int = 0, sample: int = SAMPLE,
) -> Calibration:
    """The shortest bucket length with which a search finds the wanted share of the true neighbours.

    About ``sample`` vectors, chosen by a hash of the id, get their ``k`` true neighbours. A
    sketch of the quantiles of the gap that a query and its neighbour show in the closest of
    the projections gives the first length: buckets shorter than the gap of the wanted share
    cannot hold it. From there lengths grow until the sample's neighbours share a bucket that
    is probed often enough; if none does, the longest is taken, and ``recall`` says what it gives.
    """
    rows = vectors.filter("features is not null").select(F.col("id").cast("long").alias("id"), "features")
    n, steps = rows.count(), 1 << 30
    if not n:
        raise ValueError("no vectors to calibrate an index with")
    share = min(1.0, sample / n)
    asked = rows.filter(F.pmod(F.xxhash64(F.lit("calibrate"), "id"), F.lit(steps)) < math.ceil(share * steps))
    if share == 1.0 or not asked.head(1):
        asked = rows
    true = storage.written(similar_users(rows, asked.select("id"), k, "exact"), "true-neighbours")
    near = true.agg(F.percentile_approx("dist", 0.5)).head()[0] or 1.0
    unit = fit_index(rows, seed=seed, tables=tables, bucket_length=float(near))
    placed = storage.written(_projections(rows, unit).select("id", "places"), "places")
    own = placed.join(asked.select("id"), "id", "left_semi").select(F.col("id").alias("query_id"), F.col("places").alias("own"))
    pairs = storage.written(
        true.select("query_id", "neighbor_id").join(own, "query_id").join(
            placed.select(F.col("id").alias("neighbor_id"), F.col("places").alias("other")), "neighbor_id"
        ), "pairs",
    )
    gap = F.array_min(F.zip_with("own", "other", lambda a, b: F.abs(a - b)))
    first = pairs.agg(F.percentile_approx(gap, recall)).head()[0] or 1e-6
    lengths = [first * GROWTH**j for j in range(LENGTHS)]

    def probed(own: str, length: Column) -> Column:
        return _perturbed(F.transform(own, lambda x: x / length), probes)

    def meets(length: Column) -> Column:
        codes = F.transform("other", lambda x: F.floor(x / length))
        return F.exists(F.zip_with("_probed", codes, lambda p, c: F.array_contains(p, c)), lambda x: x)

    tried = F.explode(F.array(*[F.lit(float(x)) for x in lengths])).alias("length")
    length = F.col("length")
    found = pairs.select("own", "other", tried).withColumn("_probed", probed("own", length))
    recalls = found.groupBy("length").agg(F.avg(meets(length).cast("int")).alias("recall"))
    # What a search compares, by the same queries and fewer others: pairs that meet in a bucket.
    some = placed.filter(F.pmod(F.xxhash64(F.lit("others"), "id"), F.lit(steps)) < math.ceil(share * steps / 3))
    looking = own.select("query_id", "own", tried).withColumn("_probed", probed("own", length)).select(
        "query_id", "length", F.posexplode("_probed").alias("table", "_list")
    ).withColumn("bucket", F.explode(F.array_distinct("_list"))).drop("_list")
    lying = some.select("id", "places", tried).select(
        "id", "length", F.posexplode(F.transform("places", lambda x: F.floor(x / length))).alias("table", "bucket")
    )
    met = looking.join(lying, ["length", "table", "bucket"]).select("query_id", "id", "length").distinct()
    costs = met.groupBy("length").agg((F.count("*") / F.lit(max(1, own.count() * some.count()))).alias("compared"))
    table = storage.written(
        recalls.join(costs, "length", "left").select(
            (length * float(near)).alias("bucket_length"), "recall", F.coalesce("compared", F.lit(0.0)).alias("compared")
        ), "calibration"
    )
    rows_found = table.orderBy("bucket_length").collect()  # a row per length tried
    chosen = next((r for r in rows_found if r.recall >= min(1.0, recall + MARGIN)), rows_found[-1])
    index = fit_index(rows, seed=seed, tables=tables, bucket_length=chosen.bucket_length)
    return Calibration(index, probes, chosen.recall, chosen.compared, table)


def bucket_profile(vectors: DataFrame, index: BucketedRandomProjectionLSHModel) -> DataFrame:
    """Per hash table: buckets, largest bucket, vectors in all, and comparisons a search for everyone makes.

    Shows whether a bucket length prunes anything before a search is started.
    """
    sizes = (
        signatures(vectors.select("id", "features"), index)
        .select(F.posexplode("codes").alias("table", "bucket"))
        .groupBy("table", "bucket")
        .count()
    )
    return sizes.groupBy("table").agg(
        F.count("*").alias("buckets"),
        F.max("count").alias("largest"),
        F.sum("count").alias("vectors"),
        F.sum(F.col("count").cast("decimal(38,0)") * (F.col("count") - 1)).alias("comparisons"),
    )


def similar_to(
    vectors: DataFrame,
    user_id: int,
    index: BucketedRandomProjectionLSHModel,
    k: int = 10,
    users: DataFrame | None = None,
    display: bool = False,
) -> DataFrame:
    """One user's neighbours among those that share a bucket; no rows for an unknown user.

    The same answer as of the search for many, equal distances ordered by id. One vector is
    looked up and then part of the query, so all distances are taken where the vectors lie.
    """
    rows = vectors.filter(F.col("features").isNotNull()).select(F.col("id").cast("long").alias("id"), "features")
    hashed = signatures(rows, index)
    own = hashed.filter(F.col("id") == user_id).select("features", "codes").head()
    if own is None:
        found = vectors.sparkSession.createDataFrame([], _FOUND)
    else:
        point = F.array(*[F.lit(float(x)) for x in own.features])
        shares = F.exists(F.zip_with("codes", F.array(*[F.lit(c) for c in own.codes]), lambda a, b: a == b), lambda x: x)
        fits = (F.size("features") == len(own.features)) & F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x))
        checked = F.when(fits, F.col("features")).otherwise(F.raise_error(F.lit("vectors must be whole and of one length")))
        square = F.aggregate(
            F.zip_with(checked, point, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)), F.lit(0.0), lambda t, v: t + v
        )
        near = hashed.filter(shares & (F.col("id") != user_id)).select(
            F.lit(user_id).cast("long").alias("query_id"), F.col("id").alias("neighbor_id"), F.sqrt(square).alias("dist")
        )
        found = near.orderBy("dist", "neighbor_id").limit(k)
    return _named(_ranked(found, k), users, display)


def similar_users(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = 10,
    method: str | None = None,
    index: BucketedRandomProjectionLSHModel | None = None,
    users: DataFrame | None = None,
    digits: int | None = None,
    display: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    rows_per_cell: int | None = None,
    probes: int = 0,
    max_sent_rows: int = MAX_SENT_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``neighbor_id``, ``dist``, ``username``.

    ``vectors`` has ``id`` and ``features``; ``queries`` a column ``id`` (everyone
    when left out). ``method="exact"`` compares with all vectors, ``"lsh"`` (the default
    where an index is given or the vectors are hashed) with those that share a bucket of
    ``index`` and may return fewer than ``k``; vectors that :func:`signatures` has already
    hashed need no index. With ``probes``, a query also looks into so many neighbouring buckets,
    the nearest of all tables first; those that still have fewer than ``k`` neighbours look
    into twice as many, until all have ``k`` or all buckets in :data:`REACH` are probed.
    Nobody is their own neighbour; equal distances are ordered by
    id. With ``digits`` the distance is rounded before it is ranked; ``display`` rounds it
    afterwards and fills in missing names.

    Users without a vector neither ask nor answer. Vectors of different lengths, or with
    missing or NaN entries, are an error. Counts the queries when called. Queries are broadcast up to
    ``max_broadcast_bytes``, as long as ``k`` rows each from every partition are no more than ``max_sent_rows``.
    """
    if method is None:
        method = "lsh" if index is not None or "codes" in vectors.columns else "exact"
    if method not in ("exact", "lsh"):
        raise ValueError(f"method must be 'exact' or 'lsh', is {method!r}")
    hashed = method == "lsh"
    if probes and (not hashed or index is None):
        raise ValueError("probes need method 'lsh' and an index")
    if probes:
        found = _by_rounds(vectors, queries, k, index, digits, max_broadcast_bytes, rows_per_cell, probes)
        return _named(found, users, display)
    vectors = vectors.filter(F.col("features").isNotNull())
    if hashed and "codes" not in vectors.columns:
        if index is None:
            raise ValueError("method 'lsh' needs an index, or vectors with codes")
        vectors = signatures(vectors, index)
    members = vectors.select(
        F.col("id").cast("long").alias("id"), "features", *(["codes"] if hashed else [])
    )
    ids = None if queries is None else queries.select(F.col("id").cast("long").alias("id"))

    def wanted(members: DataFrame) -> DataFrame:
        return members if ids is None else members.join(ids, "id", "left_semi")

    asked = wanted(members).agg(
        F.count("*").alias("n"), F.max(F.size("features")).alias("width"),
        *([F.max(F.size("codes")).alias("tables")] if hashed else [F.lit(0).alias("tables")]),
    ).head()
    if asked.n == 0:
        found = vectors.sparkSession.createDataFrame([], _FOUND)
    elif asked.n * (asked.width + asked.tables + 1) * 8 <= max_broadcast_bytes and _sends_little(members, asked.n * k, max_sent_rows):
        found = _by_broadcast(members, wanted(members).toArrow(), k, digits)
    else:
        # Read several times from here on, and not to be computed again when an executor is lost.
        members = storage.written(members, "vectors")
        asked = members if ids is None else storage.written(wanted(members), "queries")
        found = _by_cells(members, asked, k, digits, rows_per_cell)
    return _named(_ranked(found, k), users, display)


def _by_rounds(
    vectors: DataFrame, queries: DataFrame | None, k: int, index: BucketedRandomProjectionLSHModel, digits: int | None,
    max_broadcast_bytes: int, rows_per_cell: int | None, probes: int,
) -> DataFrame:
    """Ranked neighbours of a search that probes more buckets for the queries with fewer than ``k``, round by round."""
    rows = vectors.filter("features is not null").select(F.col("id").cast("long").alias("id"), "features")
    placed = storage.written(_projections(rows, index), "places")
    members = placed.select("id", "features", F.transform("places", lambda x: F.floor(x)).alias("codes"))
    asked, width, most = placed, 1 + 2 * REACH, 2 * REACH * index.getNumHashTables()
    if queries is not None:
        asked = placed.join(queries.select(F.col("id").cast("long").alias("id")), "id", "left_semi")
    done = None
    while True:
        probing = storage.written(asked.select("id", "features", _perturbed(F.col("places"), probes).alias("codes")), "probing")
        size = probing.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("width")).head()
        if size.n == 0:
            found = rows.sparkSession.createDataFrame([], _FOUND)
        elif size.n * (size.width + width * index.getNumHashTables() + 1) * 8 <= max_broadcast_bytes:
            found = _by_broadcast(members, probing.toArrow(), k, digits)
        else:
            found = _by_cells(members, probing, k, digits, rows_per_cell)
        ranked = storage.written(_ranked(found, k), "ranked")
        if probes >= most:
            short = None
        else:
            full = ranked.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n")).filter(F.col("n") >= k)
            short = storage.written(asked.join(full.select("id"), "id", "left_anti"), "short")
        if short is None or not short.head(1):
            return ranked if done is None else done.unionByName(ranked)
        kept = ranked.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
        done = kept if done is None else done.unionByName(kept)
        asked, probes = short, min(most, 2 * probes)


def _codes(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Buckets by row and table; of probing queries by row, table and probe."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_list(column.type.value_type):
        return matrix(column).astype(np.int64)
    inner = column.flatten()
    return matrix(inner).astype(np.int64).reshape(len(column), len(inner) // max(1, len(column)), -1)


def _sends_little(members: DataFrame, rows: int, most: int) -> bool:
    """Whether ``rows`` from every partition of the members are few. Runs a job without columns where that depends on the partitions."""
    if rows * MAX_PARTITIONS <= most:
        return True
    partitions = 1 + (members.select(F.spark_partition_id().alias("p")).agg(F.max("p")).head()[0] or 0)
    return rows * partitions <= most


def _by_broadcast(members: DataFrame, queries: pa.Table, k: int, digits: int | None) -> DataFrame:
    """Few queries: every partition keeps the ``k`` best of its own members, without a shuffle."""
    hashed = "codes" in queries.column_names
    shared = members.sparkSession.sparkContext.broadcast(
        (
            id_array(queries["id"]),
            matrix(queries["features"]),
            _codes(queries["codes"]) if hashed else None,
        )
    )

    def search(batches):
        ids, vectors, codes = shared.value
        best = Nearest(ids, vectors, k, digits, codes)
        for batch in batches:
            if batch.num_rows:
                best.add(
                    id_array(batch.column("id")),
                    matrix(batch.column("features")),
                    _codes(batch.column("codes")) if hashed else None,
                )
        yield pa.RecordBatch.from_arrays(best.result(), schema=FOUND)

    return members.mapInArrow(search, _FOUND)


def _by_cells(
    members: DataFrame, queries: DataFrame, k: int, digits: int | None, rows_per_cell: int | None
) -> DataFrame:
    """Many queries: bounded cells in which some queries meet some members.

    A bucket is cut into query blocks and member slices. Each block meets each slice
    in one group of cells, so a bucket of any size is spread over many tasks, and a group
    passes on ``k`` rows per query instead of its pairs. Rows move once per group, whose size
    follows from the cores and :data:`MAX_CELL_BYTES`; cells of ``rows_per_cell`` rows of either
    side are compared at a time, however small they are. The exact search is one bucket that
    holds everything. So is an LSH search whose buckets overlap so much that it would
    compare more than all pairs once; its cells then check the codes themselves.

    What is one bucket goes by regions first, unless ``rows_per_cell`` says what meets.
    """
    bucket, hashed = ["table", "bucket"], "codes" in members.columns

    def opened(df: DataFrame, *kept: str) -> DataFrame:
        """A row per table and bucket that a vector is in, or that a query probes."""
        rows = df.select(*kept, F.posexplode("codes").alias(*bucket))
        if dict(df.dtypes)["codes"] == "array<array<bigint>>":
            rows = rows.withColumn("bucket", F.explode(F.array_distinct("bucket")))
        return rows

    def sizes(df: DataFrame, name: str) -> DataFrame:
        rows = opened(df)
        return rows.groupBy(*bucket).agg(F.count("*").alias(name))

    if hashed:
        asked, offered = sizes(queries, "_asked"), sizes(members, "_offered")
        n_queries, n_members = queries.count(), members.count()
        shared = asked.join(offered, bucket).agg(F.sum(F.col("_asked").cast("double") * F.col("_offered"))).head()[0] or 0
        by_bucket = shared < n_queries * n_members
    else:
        n_queries, n_members, by_bucket = queries.count(), members.count(), False
    compared = shared if by_bucket else n_queries * n_members
    spark = members.sparkSession
    tasks = CELLS_PER_CORE * spark.sparkContext.defaultParallelism
    even = math.ceil(math.sqrt(compared / tasks))
    width = 8 * (members.select(F.max(F.size("features"))).head()[0] + 1)
    at_once = {} if rows_per_cell is None else {"query_rows": rows_per_cell, "member_rows": rows_per_cell}
    if not by_bucket and rows_per_cell is None:
        # Regions are cut again beyond twice these rows.
        rows = max(1, MIN_CELL_BYTES // width, min(MAX_CELL_BYTES // (2 * width), n_members // tasks))
        if n_members > 2 * rows:
            found, queries = _by_regions(members, queries, k, digits, n_queries, n_members, rows, width)
            if found is not None:
                return found
            at_once = WIDE_RUNS
    moved = max(1, rows_per_cell or 1, min(MAX_CELL_BYTES // width, max(MIN_CELL_BYTES // width, even)))
    # A group is much work for few bytes: the partitions are numbered by work, so that
    # adaptive execution does not merge them by size. Few groups get more partitions than
    # there are groups, as hashing would put several of them into one.
    tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = math.ceil(compared / moved**2)
    partitions = max(1, min(4 * cells, max(16 * tasks, cells)))

    def cut(df: DataFrame) -> DataFrame:
        """Adds the bucket, and into how many blocks and slices it is cut."""
        if by_bucket:
            rows = opened(df, "id", "features")
            for counts, rows_name, name in ((asked, "_asked", "_blocks"), (offered, "_offered", "_slices")):
                hot = skew.hot_keys(counts, bucket, rows_name, moved, name)
                rows = rows.join(hot, bucket, "left")
            return rows.fillna(1, ["_blocks", "_slices"])
        return df.select(
            "*", F.lit(0).alias("table"), F.lit(0).cast("long").alias("bucket"),
            F.lit(max(1, math.ceil(n_queries / moved))).alias("_blocks"),
            F.lit(max(1, math.ceil(n_members / moved))).alias("_slices"),
        )

    # Cells of one bucket know that their rows share it; otherwise the codes travel along.
    payload = ["id", "features", "codes"] if hashed and not by_bucket else ["id", "features"]

    def placed(df: DataFrame, own: str, own_cut: str, other: str, other_cut: str) -> DataFrame:
        return cut(df).select(
            *bucket, *payload, *(["bound"] if "bound" in df.columns else []),
            F.pmod(F.xxhash64("id"), F.col(own_cut)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_cut) - 1)).alias(other),
        )

    cell = [*bucket, "block", "slice"]
    left = placed(queries, "block", "_blocks", "slice", "_slices")
    right = placed(members, "slice", "_slices", "block", "_blocks")
    # Both sides come from the same table: give one its own column identities.
    right = right.toDF(*right.columns)
    found = _met(left, right, cell, partitions, k, digits, at_once)
    if not by_bucket:
        return found
    # A pair may share buckets in several tables; the ranking reuses this partitioning.
    return found.repartition("query_id").groupBy("query_id", "neighbor_id").agg(F.min("dist").alias("dist"))


def _met(left: DataFrame, right: DataFrame, cell: list[str], partitions: int, k: int, digits: int | None, at_once: dict[str, int]) -> DataFrame:
    """Neighbours of the queries on the left among the members on the right, cell by cell.

    Columns ``codes`` are checked pair by pair; farther than a query's ``bound`` nobody is looked for.
    """
    check, bounded = "codes" in left.columns, "bound" in left.columns
    left, right = (df.repartition(partitions, *cell) for df in (left, right))

    def search(asking: pa.Table, offering: pa.Table) -> pa.Table:
        if not asking.num_rows or not offering.num_rows:
            return FOUND.empty_table()
        codes = [_codes(t["codes"]) if check else None for t in (asking, offering)]
        bound = asking["bound"].to_numpy() if bounded else None
        best = Nearest(id_array(asking["id"]), matrix(asking["features"]), k, digits, codes[0], bound=bound, **at_once)
        best.add(id_array(offering["id"]), matrix(offering["features"]), codes[1])
        return pa.Table.from_arrays(best.result(), schema=FOUND)

    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, _FOUND)


def _by_regions(
    members: DataFrame, queries: DataFrame, k: int, digits: int | None, n_queries: int, n_members: int, rows: int, width: int
) -> tuple[DataFrame | None, DataFrame]:
    """Neighbours by regions of about ``rows`` members, ``width`` bytes each: first the own one, then those that can be near enough.

    A sample says where space is cut, the members themselves how far each region reaches. The
    last neighbour a query has from its own region bounds how far it looks: the regions within
    that get the query too, all others hold nobody nearer. Regions and visitors beyond twice
    ``rows`` are cut into slices and blocks. Where nearly everything is near, as among many
    independent entries, there are no neighbours but the queries with their ``bound``, to be compared with all.
    """
    spark = members.sparkSession
    sampled = min(SAMPLED_PER_REGION * math.ceil(n_members / rows), max(2, MAX_BROADCAST_BYTES // width))
    share = min(1.0, sampled / n_members)
    sample = matrix(members.filter(F.rand(0) < share).select("features").toArrow()["features"])
    if not len(sample):
        return None, queries
    tree = Regions(sample, max(1, math.floor(share * rows)))
    room = 0.0 if digits is None else 10.0**-digits

    def placed(df: DataFrame) -> DataFrame:
        def place(batches):
            for batch in batches:
                region = pa.array(tree.of(matrix(batch.column("features"))), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns, region], names=[*batch.schema.names, "region"])

        return storage.written(df.mapInArrow(place, StructType([*df.schema.fields, StructField("region", IntegerType())])), "regions")

    def reached(batches):
        """Per region of a partition's members, how many, their smallest and their largest entries."""
        n = np.zeros(tree.n_regions, np.int64)
        low, high = np.full((2, tree.n_regions, tree.width), np.inf) * np.array([1.0, -1.0])[:, None, None]
        for batch in batches:
            if batch.num_rows:
                own, counts, least, most = boxes(matrix(batch.column("features")), id_array(batch.column("region")))
                n[own] += counts
                low[own], high[own] = np.minimum(low[own], least), np.maximum(high[own], most)
        own = np.flatnonzero(n)
        starts = pa.array(np.arange(len(own) + 1) * tree.width, pa.int32())
        ends = [pa.ListArray.from_arrays(starts, pa.array(x[own].ravel(), pa.float64())) for x in (low, high)]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(n[own], pa.int64()), *ends], names=["region", "n", "low", "high"])

    everyone = queries is members
    members = placed(members)
    queries = members if everyone else placed(queries)
    reach = members.select("features", "region").mapInArrow(reached, "region int, n long, low array<double>, high array<double>").select(
        "region", "n", F.posexplode(F.arrays_zip("low", "high")).alias("entry", "end")
    ).groupBy("region", "entry").agg(F.sum("n").alias("n"), F.min("end.low").alias("low"), F.max("end.high").alias("high"))
    ends = reach.toArrow()  # a row per region and entry
    at = ends["region"].to_numpy(), ends["entry"].to_numpy()
    offered = dict(zip(at[0].tolist(), ends["n"].to_pylist()))
    low, high = np.full((2, tree.n_regions, tree.width), np.inf) * np.array([1.0, -1.0])[:, None, None]
    low[at], high[at] = ends["low"].to_numpy(), ends["high"].to_numpy()
    tree.set_boxes(low, high)

    entries = width // 8 - 1
    at_once = NARROW_RUNS if entries <= NARROW else {}
    tasks = max(CELLS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    payload = [c for c in ("id", "features", "codes") if c in members.columns]
    cell = ["region", "block", "slice"]

    def counted(df: DataFrame) -> dict[int, int]:
        return {r.region: r.n for r in df.groupBy("region").agg(F.count("*").alias("n")).collect()}  # a row per region

    def met(asking: DataFrame, asked: dict[int, int]) -> DataFrame:
        """Neighbours of the queries among the members of the region they are given with."""
        cut = [(r, math.ceil(n / (2 * rows)), math.ceil(offered[r] / (2 * rows))) for r, n in asked.items() if r in offered]
        cuts = F.broadcast(spark.createDataFrame(cut, "region int, _blocks int, _slices int"))
        cells = sum(blocks * slices for _, blocks, slices in cut)
        # As in the search by cells, more partitions than cells.
        partitions = max(1, min(4 * cells, max(16 * tasks, cells)))

        def dealt(df: DataFrame, own: str, own_cut: str, other: str, other_cut: str) -> DataFrame:
            return df.join(cuts, "region").select(
                "region", *payload, *(["bound"] if "bound" in df.columns else []),
                F.pmod(F.xxhash64("id"), F.col(own_cut)).cast("int").alias(own),
                F.explode(F.sequence(F.lit(0), F.col(other_cut) - 1)).alias(other),
            )

        right = dealt(members, "slice", "_slices", "block", "_blocks")
        return _met(dealt(asking, "block", "_blocks", "slice", "_slices"), right.toDF(*right.columns), cell, partitions, k, digits, at_once)

    at_home = storage.written(_ranked(met(queries, counted(queries)), k), "own-region")
    bounds = at_home.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("dist").alias("bound"))

    def look(batches):
        for batch in batches:
            bound = id_array(batch.column("bound"))
            row, region = np.empty(0, np.int64), np.empty(0, np.int32)
            if batch.num_rows:
                row, region = tree.visits(matrix(batch.column("features")), id_array(batch.column("region")), bound + room)
            starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))])
            visits = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(region, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, visits], names=[*batch.schema.names, "visits"])

    bounded = queries.join(bounds, "id", "left").select(*payload, "region", F.coalesce("bound", F.lit(math.inf)).alias("bound"))
    looking = storage.written(
        bounded.mapInArrow(look, StructType([*bounded.schema.fields, StructField("visits", ArrayType(IntegerType()))])), "visits"
    )
    visiting = looking.select(*payload, "bound", F.explode("visits").alias("region"))
    asked = counted(visiting)
    if sum(n * offered.get(r, 0) for r, n in asked.items()) > MAX_VISITED * n_queries * n_members:
        return None, looking.select(*payload, "bound")
    found = at_home.drop("rank")
    return (found.unionByName(met(visiting, asked)) if asked else found), queries


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of the partial results."""
    order = Window.partitionBy("query_id").orderBy("dist", "neighbor_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "neighbor_id", "dist")
    )


def _named(found: DataFrame, users: DataFrame | None, display: bool) -> DataFrame:
    """Adds ``username``: NULL for a user the dimension lacks, and without a dimension."""
    if users is None:
        named = found.withColumn("username", F.lit(None).cast("string"))
    else:
        names = schemas.one_per_key(
            users.select(F.col("user_id").cast("long").alias("neighbor_id"), F.col("Username").alias("username")),
            "neighbor_id",
        )
        named = skew.lookup(found, names, "neighbor_id")
    dist, username = F.col("dist"), F.col("username")
    if display:
        dist = F.round(dist, columns.DISTANCE_DIGITS)
        username = F.coalesce(username, F.lit(columns.UNKNOWN_USERNAME))
    return named.select("query_id", "rank", "neighbor_id", dist.alias("dist"), username.alias("username"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``pairs_found``, ``pairs_exact``, ``recall`` of the exact neighbour pairs."""
    pair = ["query_id", "neighbor_id"]
    both = exact.select(*pair).join(
        found.select(*pair).withColumn("_hit", F.lit(1)), pair, "left"
    )
    return both.agg(
        F.count("_hit").alias("pairs_found"),
        F.count("*").alias("pairs_exact"),
        (F.count("_hit") / F.count("*")).alias("recall"),
    )
