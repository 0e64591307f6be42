import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.functions.nearest import Nearest
from earshot.operators import similar

VECTORS = "id long, features array<float>"


def brute(vectors, k, digits=None, allowed=lambda a, b: True):
    found = {}
    for a, va in vectors.items():
        near = []
        for b, vb in vectors.items():
            if a != b and allowed(a, b):
                d = float(np.sqrt(((np.float64(va) - np.float64(vb)) ** 2).sum()))
                near.append((round(d, digits) if digits is not None else d, b))
        found[a] = sorted(near)[:k]
    return found


def found_of(df):
    result = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = result.setdefault(r.query_id, [])
        own.append((r.dist, r.neighbor_id))
        assert r.rank == len(own)
        assert r.query_id != r.neighbor_id
    return result


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(150, 6)).astype(np.float32)
    values[100:140] = values[100]  # a group of copies
    return {i * 3: values[i] for i in range(150)}


@pytest.fixture(scope="module")
def vectors(spark, data):
    rows = [(i, [float(x) for x in v]) for i, v in data.items()]
    return spark.createDataFrame(rows, VECTORS).repartition(6).cache()


@settings(max_examples=60, deadline=None)
@given(
    values=st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=2, max_size=40),
    k=st.integers(1, 6),
    pieces=st.integers(1, 5),
    digits=st.sampled_from([None, 1, 6]),
)
def test_kernel_equals_sorting(values, k, pieces, digits):
    table = {i: np.array(v, np.float64) for i, v in enumerate(values)}
    ids, rows = np.arange(len(values)), np.array(values, np.float64)
    best = Nearest(ids, rows, k, digits)
    for part in np.array_split(np.random.default_rng(0).permutation(len(values)), pieces):
        best.add(ids[part], rows[part])
    got = {}
    for q, m, d in sorted(zip(*(c.to_pylist() for c in best.result())), key=lambda t: (t[0], t[2], t[1])):
        got.setdefault(q, []).append((pytest.approx(d, abs=1e-9), m))
    assert got == {a: near for a, near in brute(table, k, digits).items() if near}


@pytest.mark.parametrize("way", [{}, {"max_broadcast_bytes": 0, "rows_per_cell": 16}])
@pytest.mark.parametrize("digits", [None, 3])
def test_exact_equals_brute_force(vectors, data, way, digits):
    got = found_of(similar.similar_users(vectors, k=5, digits=digits, **way))
    want = brute(data, 5, digits)
    assert got.keys() == want.keys()
    for a in want:
        assert [b for _, b in got[a]] == [b for _, b in want[a]]
        assert [d for d, _ in got[a]] == pytest.approx([d for d, _ in want[a]], abs=1e-9)


@pytest.mark.parametrize("tables, length", [(2, 0.7), (2, 0.1), (6, 2.0)])
@pytest.mark.parametrize("way", [{}, {"max_broadcast_bytes": 0, "rows_per_cell": 16}])
def test_lsh_equals_a_plain_bucket_join(spark, vectors, data, way, tables, length):
    index = similar.fit_index(vectors, seed=3, tables=tables, bucket_length=length)
    rows = similar.signatures(vectors, index).select("id", F.posexplode("codes").alias("table", "bucket"))
    pairs = (
        rows.alias("a").join(rows.withColumnRenamed("id", "other"), ["table", "bucket"])
        .filter("id <> other").select("id", "other").distinct().collect()
    )
    shares = {(r.id, r.other) for r in pairs}
    assert len(shares) < 150 * 149
    want = {a: near for a, near in brute(data, 5, 6, lambda a, b: (a, b) in shares).items() if near}
    got = found_of(similar.similar_users(vectors, k=5, method="lsh", index=index, digits=6, **way))
    assert got == want
    some = spark.createDataFrame([(i,) for i in range(0, 300, 9)], "id long")
    hashed = similar.signatures(vectors, index).cache()
    got = found_of(similar.similar_users(hashed, some, k=5, method="lsh", digits=6, **way))
    assert got == {a: near for a, near in want.items() if a % 9 == 0 and a < 300}


def test_search_for_one_user_equals_the_batch(vectors):
    index = similar.fit_index(vectors, seed=5)
    one = found_of(similar.similar_to(vectors, 0, index, k=7))
    batch = found_of(similar.similar_users(vectors, k=7, method="lsh", index=index))
    assert one[0] == [(pytest.approx(d, abs=1e-9), b) for d, b in batch[0]]
    assert similar.similar_to(vectors, 1, index).count() == 0


def test_copies_give_exactly_k_neighbours(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], VECTORS)
    index = similar.fit_index(same, seed=1)
    for found in (
        similar.similar_users(same, k=2),
        similar.similar_users(same, k=2, method="lsh", index=index),
        similar.similar_users(same, k=2, max_broadcast_bytes=0, rows_per_cell=2),
        similar.similar_to(same, 3, index, k=2),
    ):
        for near in found_of(found).values():
            assert [d for d, _ in near] == [0.0, 0.0]
    assert found_of(similar.similar_users(same, k=2))[3] == [(0.0, 0), (0.0, 1)]


def test_one_search_breaks_ties_by_id(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(1, 41)], VECTORS).repartition(5)
    one = similar.similar_to(same, 1, similar.fit_index(same, seed=1), k=3).orderBy("rank").collect()
    assert [r.neighbor_id for r in one] == [2, 3, 4]


@pytest.mark.parametrize("way", [{}, {"max_broadcast_bytes": 0, "rows_per_cell": 3}])
def test_users_without_a_vector_take_no_part(spark, way):
    rows = [(i, [float(i), 0.0, 1.0, 2.0] if i % 2 else None) for i in range(8)]
    found = similar.similar_users(spark.createDataFrame(rows, VECTORS), k=8, **way).collect()
    assert {(r.query_id, r.neighbor_id) for r in found} == {(a, b) for a in (1, 3, 5, 7) for b in (1, 3, 5, 7) if a != b}
    assert all(r.dist == abs(r.query_id - r.neighbor_id) for r in found)


@pytest.mark.parametrize("bad", [[1.0], [1.0, None], [1.0, float("nan")]])
@pytest.mark.parametrize("way", [{}, {"max_broadcast_bytes": 0, "rows_per_cell": 2}])
def test_bad_vectors_are_refused(spark, bad, way):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, bad)], VECTORS)
    with pytest.raises(Exception, match="vectors must"):
        similar.similar_users(df, k=2, **way).collect()


def test_display(spark, vectors):
    users = spark.createDataFrame([(3, "ana")], "user_id long, Username string")
    shown = similar.similar_users(vectors, k=149, users=users, display=True).filter("query_id = 0")
    assert {r.username for r in shown.collect()} == {"ana", "N/A"}
    assert shown.filter("dist <> round(dist, 4)").count() == 0


def test_queries_names_and_schema(spark, vectors):
    ids = spark.createDataFrame([(0,), (0,), (1,), (6,)], "id long")
    users = spark.createDataFrame([(3, "ana"), (3, "bea")], "user_id long, Username string")
    named = similar.similar_users(vectors, ids, k=149, users=users)
    assert named.columns == ["query_id", "rank", "neighbor_id", "dist", "username"]
    assert named.count() == 2 * 149
    assert {r.username for r in named.filter("neighbor_id = 3").collect()} == {"ana"}
    assert named.filter("neighbor_id <> 3 AND username IS NOT NULL").count() == 0
    plain = similar.similar_users(vectors, ids.filter("id = 1"), k=3)
    assert plain.columns == named.columns and plain.count() == 0
    with pytest.raises(ValueError, match="method"):
        similar.similar_users(vectors, method="guess")
    with pytest.raises(ValueError, match="index"):
        similar.similar_users(vectors, method="lsh")


def test_index_is_repeatable(vectors):
    codes = [
        sorted(map(tuple, similar.signatures(vectors, similar.fit_index(vectors, seed=s)).select("id", "codes").collect()))
        for s in (1, 1, 2)
    ]
    assert codes[0] == codes[1] != codes[2]


def test_bucket_profile_and_recall(spark, vectors):
    index = similar.fit_index(vectors, seed=3, tables=3, bucket_length=0.5)
    profile = similar.bucket_profile(vectors, index).collect()
    assert sorted(r.table for r in profile) == [0, 1, 2]
    for r in profile:
        assert r.largest <= 150 and r.comparisons <= 150 * 149
    exact = similar.similar_users(vectors, k=5)
    assert similar.recall(exact, exact).head().recall == 1.0
    found = similar.similar_users(vectors, k=5, method="lsh", index=index)
    row = similar.recall(found, exact).head()
    assert 0 < row.recall <= 1 and row.pairs_exact == 750


def by_hand_probes(places, probes, reach):
    """Buckets per table, from the gaps of all tables together."""
    gaps = []
    for t, x in enumerate(places):
        inside = x - np.floor(x)
        for r in range(1, reach + 1):
            gaps += [(inside + r - 1, t, -r), (r - inside, t, r)]
    chosen = sorted(gaps)[:probes]
    return [{int(np.floor(x))} | {int(np.floor(x)) + d for _, u, d in chosen if u == t} for t, x in enumerate(places)]


@pytest.mark.parametrize("probes", [0, 1, 3, 7, 100])
def test_probes_are_the_nearest_buckets(spark, probes):
    rng = np.random.default_rng(5)
    rows = [(i, rng.uniform(-3, 3, 4).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, places array<double>")
    got = {r.id: r.p for r in df.select("id", similar._perturbed(F.col("places"), probes, 2).alias("p")).collect()}
    for i, places in rows:
        assert [set(p) for p in got[i]] == by_hand_probes(places, probes, 2)
        assert len({len(p) for p in got[i]}) == 1


@pytest.fixture(scope="module")
def embeddings(spark, sf_dir):
    import workload

    return workload.embedding_vectors(spark, sf_dir).cache()


def test_projections_have_the_buckets_as_floor(embeddings):
    index = similar.fit_index(embeddings, seed=3, bucket_length=0.2)
    rows = similar.multi_probe(embeddings, index, 4).join(
        similar.signatures(embeddings, index).select("id", F.col("codes").alias("want")), "id"
    ).collect()
    assert all(r.codes == r.want for r in rows)
    assert all(len({*p}) <= 5 and c == p[0] for r in rows for c, p in zip(r.codes, r.probes))
    assert all(sum(len({*p}) - 1 for p in r.probes) == 4 for r in rows)


@pytest.mark.parametrize("bytes_", [similar.MAX_BROADCAST_BYTES, 0])
def test_probing_finds_what_shares_a_probed_bucket(embeddings, bytes_):
    index = similar.fit_index(embeddings, seed=3, tables=3, bucket_length=0.05)
    found = similar.similar_users(embeddings, k=5, index=index, probes=4, max_broadcast_bytes=bytes_, rows_per_cell=64)
    rows = similar.multi_probe(embeddings, index, 4).collect()
    vectors = {r.id: np.array(r.features, float) for r in rows}
    codes = {r.id: r.codes for r in rows}
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.neighbor_id, r.dist))
    checked = 0
    for r in rows:
        near = [j for j in codes if j != r.id and any(c in p for c, p in zip(codes[j], r.probes))]
        if len(near) < 5:
            continue  # a later round has probed more for it
        best = sorted((np.linalg.norm(vectors[r.id] - vectors[j]), j) for j in near)[:5]
        assert [j for _, j, _ in sorted(got[r.id])] == [j for _, j in best]
        checked += 1
    assert checked > 100
    assert len(got) == len(rows) and all(len(x) == 5 for x in got.values())


def test_calibrated_index_finds_the_wanted_share(embeddings):
    exact = similar.similar_users(embeddings, k=10, method="exact")
    for wanted, probes in ((0.9, 0), (0.9, 6)):
        made = similar.calibrate(embeddings, seed=7, recall=wanted, probes=probes)
        found = similar.similar_users(embeddings, k=10, index=made.index, probes=made.probes)
        measured = similar.recall(found, exact).head()["recall"]
        assert measured >= wanted and made.recall >= wanted
        # It prunes, and no length that is shorter would have done on the sample.
        assert 0 < made.compared < 1
        shorter = [r.recall for r in made.table.collect() if r.bucket_length < made.index.getBucketLength() * 0.999]
        assert all(r < wanted + similar.MARGIN for r in shorter)


def test_probes_need_an_index(embeddings):
    with pytest.raises(ValueError, match="index"):
        similar.similar_users(embeddings, probes=2)
    with pytest.raises(ValueError, match="calibrate"):
        similar.calibrate(embeddings.limit(0), seed=1)


@pytest.mark.parametrize("method", ["exact", "lsh"])
def test_small_cells_do_not_move_more_rows(spark, method, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, VECTORS)
    index = similar.fit_index(df, seed=1, bucket_length=50.0) if method == "lsh" else None
    moved = []

    def counted(self, *key, real=type(df).groupBy):
        if key[-2:] == ("block", "slice"):
            moved.append(self.count())
        return real(self, *key)

    monkeypatch.setattr(type(df), "groupBy", counted)
    found = similar.similar_users(df, k=4, method=method, index=index, max_broadcast_bytes=0, rows_per_cell=4)
    assert moved == [900, 900]
    monkeypatch.setattr(similar, "MIN_CELL_BYTES", 32 * 100)
    monkeypatch.setattr(similar, "MAX_CELL_BYTES", 32 * 100)
    groups = similar.similar_users(df, k=4, method=method, index=index, max_broadcast_bytes=0, rows_per_cell=4)
    assert moved[2:] == [8100, 8100]
    want = {a: [b for _, b in near] for a, near in brute({i: np.array(v, np.float32) for i, v in rows}, 4).items()}
    for df in (found, groups):
        assert {a: [b for _, b in near] for a, near in found_of(df).items()} == want


def test_far_boxes_are_not_compared(monkeypatch):
    rng = np.random.default_rng(9)
    rows, cells = rng.random((8192, 2)), []
    real = Nearest._add_block
    monkeypatch.setattr(Nearest, "_add_block", lambda self, *a: (cells.append(1), real(self, *a)))
    best = Nearest(np.arange(8192), rows, 3)
    best.add(np.arange(8192), rows)
    assert len(cells) < 0.6 * (8192 // 256) * (8192 // 512)
    got = sorted(zip(*(c.to_pylist() for c in best.result())))
    for q in range(0, 8192, 700):
        near = np.sqrt(((rows - rows[q]) ** 2).sum(axis=1))
        near[q] = np.inf
        assert {m for a, m, _ in got if a == q} == {*np.argsort(near)[:3].tolist()}


def test_members_of_one_bucket_need_no_check_by_pair(monkeypatch):
    rng = np.random.default_rng(10)
    rows = rng.random((1500, 3))
    codes = np.column_stack([np.zeros(1500, int), np.arange(1500) % 7])
    cells = []
    real = Nearest._add_block
    monkeypatch.setattr(Nearest, "_add_block", lambda self, *a: (cells.append(a[-1]), real(self, *a)))
    found = []
    for c in (codes, None):
        best = Nearest(np.arange(1500), rows, 5, 6, c)
        best.add(np.arange(1500), rows, c)
        found.append(sorted(zip(*(x.to_pylist() for x in best.result()))))
    assert found[0] == found[1] and cells and all(c is None for c in cells)


def test_codes_are_looked_at_for_near_pairs_only():
    rng = np.random.default_rng(3)
    rows, n = rng.normal(size=(6000, 4)), 6000
    places = rows @ rng.normal(size=(4, 3))
    codes = np.floor(places).astype(np.int64)
    probes = np.stack([codes, codes - 1, codes + 1], axis=2)
    seen = []

    class Counted(np.ndarray):
        def __eq__(self, other):
            out = np.asarray(self) == np.asarray(other)
            seen.append(out.size)
            return out

    best = Nearest(np.arange(500), rows[:500], 3, None, probes[:500].view(Counted))
    best.add(np.arange(n), rows, codes.view(Counted))
    query, member, dist = (c.to_numpy() for c in best.result())
    gaps = np.sqrt(((rows[:500, None] - rows[None]) ** 2).sum(axis=2))
    gaps[~(probes[:500, None] == codes[None, :, :, None]).any(axis=(2, 3))] = np.inf
    gaps[np.arange(500), np.arange(500)] = np.inf
    want = np.argsort(gaps, axis=1, kind="stable")[:, :3]
    order = np.lexsort((member, dist, query))
    assert (member[order].reshape(500, 3) == want).all()
    # All pairs, codes and probes would be 500 * n * 9.
    assert sum(seen) < 0.3 * 500 * n * 9


@pytest.mark.parametrize("scale, shift", [(1e-25, 0.0), (1e25, 0.0), (1.0, 1e6), (1e-4, 3.0), (1.0, 0.0)])
@pytest.mark.parametrize("hashed", [False, True])
def test_rough_distances_lose_nobody(scale, shift, hashed):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(700, 5)) * scale + shift
    rows[300:340] = rows[300]
    codes = rng.integers(0, 3, (700, 2)) if hashed else None
    best = Nearest(np.arange(700), rows, 4, None, codes, query_rows=64, member_rows=50)
    for part in np.array_split(rng.permutation(700), 3):
        best.add(part, rows[part], None if codes is None else codes[part])
    query, member, dist = (c.to_numpy() for c in best.result())
    order = np.lexsort((member, dist, query))
    gaps = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(axis=2))
    if hashed:
        gaps[~(codes[:, None] == codes[None]).any(axis=2)] = np.inf
    gaps[np.arange(700), np.arange(700)] = np.inf
    assert (member[order].reshape(700, 4) == np.argsort(gaps, axis=1, kind="stable")[:, :4]).all()


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    rows = rng.random((20, width))[rng.integers(0, 20, n)] + rng.normal(size=(n, width)) * 0.01
    rows[n // 3 : n // 3 + n // 6] = rows[0]  # a group of copies
    return {i * 2: row for i, row in enumerate(rows.astype(np.float32))}


def table(spark, data):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data.items()], VECTORS).repartition(4)


@pytest.fixture
def small_regions(monkeypatch):
    monkeypatch.setattr(similar, "MIN_CELL_BYTES", 1 << 10)
    monkeypatch.setattr(similar, "MAX_CELL_BYTES", 1 << 12)


@pytest.mark.parametrize("digits", [None, 2])
@pytest.mark.parametrize("method", ["exact", "lsh"])
def test_search_by_regions_equals_brute_force(spark, small_regions, method, digits):
    data = clustered(300, 3, 4)
    df = table(spark, data).cache()
    index, allowed = None, lambda a, b: True
    if method == "lsh":
        index = similar.fit_index(df, seed=3, bucket_length=2.0)
        codes = {r.id: r.codes for r in similar.signatures(df, index).collect()}
        allowed = lambda a, b: any(x == y for x, y in zip(codes[a], codes[b]))
    want = {a: near for a, near in brute(data, 4, digits, allowed).items() if near}
    got = found_of(similar.similar_users(df, k=4, method=method, index=index, digits=digits, max_broadcast_bytes=0))
    assert {a: [b for _, b in near] for a, near in got.items()} == {a: [b for _, b in near] for a, near in want.items()}
    for a, near in want.items():
        assert [d for d, _ in got[a]] == pytest.approx([d for d, _ in near], abs=1e-9)
    if digits is not None:
        return
    some = spark.createDataFrame([(i,) for i in range(0, 300, 3)], "id long")
    part = found_of(similar.similar_users(df, some, k=4, method=method, index=index, digits=digits, max_broadcast_bytes=0))
    assert part == {a: near for a, near in got.items() if a % 3 == 0 and a < 300}


def pairs_met(monkeypatch, df, **how):
    """The pairs that meet in cells, over all rounds, and what is found."""
    sides = []

    def counted(self, *key, real=type(df).groupBy):
        if [str(c) for c in key[-2:]] == ["block", "slice"]:
            sides.append({tuple(r[c] for c in key): r.n for r in real(self, *key).agg(F.count("*").alias("n")).collect()})
        return real(self, *key)

    with monkeypatch.context() as m:
        m.setattr(type(df), "groupBy", counted)
        found = found_of(similar.similar_users(df, max_broadcast_bytes=0, **how))
    return sum(n * right.get(c, 0) for left, right in zip(sides[::2], sides[1::2]) for c, n in left.items()), found


@pytest.mark.parametrize("method", ["exact", "lsh"])
def test_far_regions_do_not_meet(spark, small_regions, monkeypatch, method):
    data = clustered(500, 3, 6)
    df = table(spark, data).cache()
    index = similar.fit_index(df, seed=1, bucket_length=50.0) if method == "lsh" else None
    pairs, got = pairs_met(monkeypatch, df, k=4, method=method, index=index)
    assert pairs < 0.4 * 500 * 500
    assert {a: [b for _, b in near] for a, near in got.items()} == {a: [b for _, b in near] for a, near in brute(data, 4).items()}


@pytest.mark.parametrize("probes", [0, 3])
def test_where_all_is_near_all_pairs_meet_with_a_bound(spark, small_regions, monkeypatch, probes):
    rng = np.random.default_rng(7)
    data = {i: row for i, row in enumerate(rng.normal(size=(300, 40)).astype(np.float32))}
    df = table(spark, data).cache()
    index = similar.fit_index(df, seed=1, bucket_length=1000.0) if probes else None
    pairs, got = pairs_met(monkeypatch, df, k=4, index=index, probes=probes)
    assert 300 * 300 < pairs < 1.5 * 300 * 300
    assert {a: [b for _, b in near] for a, near in got.items()} == {a: [b for _, b in near] for a, near in brute(data, 4).items()}


def test_equal_vectors_and_repeated_ids_are_cut_into_slices(spark, small_regions, monkeypatch):
    rows = [(i % 150, [1.0, 2.0, 0.5]) for i in range(300)] + [(1000 + i, [float(i), 0.0, 0.0]) for i in range(200)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4).cache()
    one, two = (similar.similar_users(df, k=3, max_broadcast_bytes=0, rows_per_cell=rows_per_cell) for rows_per_cell in (None, 16))
    assert sorted(map(tuple, one.drop("username").collect())) == sorted(map(tuple, two.drop("username").collect()))


@pytest.mark.parametrize("bad", [[1.0], [1.0, None], [1.0, float("nan")]])
def test_regions_refuse_bad_vectors(spark, small_regions, bad):
    rows = [(i, [float(i), 1.0]) for i in range(200)] + [(500, bad)]
    with pytest.raises(Exception, match="vectors must"):
        similar.similar_users(spark.createDataFrame(rows, VECTORS).repartition(3), k=2, max_broadcast_bytes=0).collect()


@pytest.mark.parametrize("hashed", [False, True])
def test_near_pairs_wait_to_be_ranked_together(monkeypatch, hashed):
    rng = np.random.default_rng(11)
    rows, ranked = rng.normal(size=(4000, 12)), []
    codes = rng.integers(0, 2, (4000, 3)) if hashed else None
    first = Nearest(np.arange(500), rows[:500], 5, None, None if codes is None else codes[:500])
    first.add(np.arange(1000), rows[:1000], None if codes is None else codes[:1000])
    bound = np.empty(500)
    bound[first.ids] = first.bound
    real = Nearest._keep_best
    monkeypatch.setattr(Nearest, "_keep_best", lambda self, *a: (ranked.append(1), real(self, *a)))
    best = Nearest(np.arange(500), rows[:500], 5, None, None if codes is None else codes[:500], 250, 100, bound=bound)
    best.add(np.arange(4000), rows, codes)
    # Two runs of queries meet 40 of members each.
    assert 0 < len(ranked) < 40
    query, member, dist = (c.to_numpy() for c in best.result())
    gaps = np.sqrt(((rows[:500, None] - rows[None]) ** 2).sum(axis=2))
    if hashed:
        gaps[~(codes[:500, None] == codes[None]).any(axis=2)] = np.inf
    gaps[np.arange(500), np.arange(500)] = np.inf
    order = np.lexsort((member, dist, query))
    assert (member[order].reshape(500, 5) == np.argsort(gaps, axis=1, kind="stable")[:, :5]).all()
    assert (dist <= bound[query]).all()
