import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.llm import kernel, queries

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def judged(spark):
    rows = queries.op11_kernel(spark, BIG)
    return rows.join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id", "left").toPandas()


def test_held_out_documents_are_told_apart(judged):
    held = judged[judged.held_out & judged.quality.notna()]
    assert len(held) > 80
    assert (held.predicted == held.quality).mean() >= 0.97
    good, bad = held[held.quality == 1].score.values, held[held.quality == 0].score.values
    assert np.mean(good[:, None] > bad[None, :]) >= 0.98


def test_scores_are_probabilities_and_whole(spark, judged):
    assert len(judged) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert judged.score.between(0, 1).all() and ((judged.score >= 0.5) == (judged.predicted == 1)).all()


def test_no_label_of_a_held_out_row_is_used(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    flipped = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    one, two = ({r.doc_id: r.score for r in kernel.quality(docs, x, learn).collect()} for x in (labels, flipped))
    assert one == two


def test_source_lang_and_id_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = kernel.fit(kernel.measured(docs), labels.select("doc_id", F.col("quality").alias("label")))
    other = docs.withColumn("doc_id", -F.col("doc_id")).withColumn("source", F.lit("x")).withColumn("lang", F.lit(None).cast("string"))
    one = {r.doc_id: r.score for r in kernel.scored(kernel.measured(docs), model).collect()}
    two = {-r.doc_id: r.score for r in kernel.scored(kernel.measured(other), model).collect()}
    assert one == two


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(4, 1, "clash"), (5, 0, None), (6, 0, None), (6, 1, None), (8, None, None), (9, 7, None), (None, 1, None)],
        "doc_id long, quality int, text string",
    )
    rows = kernel.quality(odd_docs, labels, F.lit(True)).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    assert kernel.quality(no_docs, labels, F.lit(True)).collect() == []


def test_no_labels_and_one_class(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in kernel.quality(odd_docs, none, F.lit(True)).collect()} == {0.5}
    bad = spark.createDataFrame([(i, 0) for i in range(1, 11)], "doc_id long, quality int")
    assert all(r.predicted == 0 for r in kernel.quality(odd_docs, bad, F.lit(True)).collect())


def test_the_sample_is_bounded_and_repeatable(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("label"))
    some = {r.doc_id for r in kernel.sample(labels, 1000).collect()}
    assert 850 < len(some) < 1150
    assert some == {r.doc_id for r in kernel.sample(labels.repartition(7), 1000).collect()}
    assert kernel.sample(labels, 20_000).count() == 20_000


def test_normal_equations_are_those_of_all_rows_at_once(spark, docs):
    stats = kernel.measured(docs).withColumn("label", (F.col("doc_id") % 3).cast("double"))
    table = stats.toPandas()
    x, y = np.stack(table.stats).astype(float), table.label.values
    rng = np.random.default_rng(1)
    model = kernel.Classifier(
        x.mean(0), np.maximum(x.std(0), 1e-9), rng.standard_normal((x.shape[1], 30)), rng.uniform(0, 6, 30), np.zeros(31), np.zeros(1), np.zeros(1)
    )
    z = model.features(x)
    got = kernel.normal_equations(stats.repartition(7), model)
    assert np.allclose(got, z.T @ np.column_stack([z, y]))


def test_products_of_features_are_the_kernel():
    rng = np.random.default_rng(2)
    width, n = len(kernel.STATISTICS), 40_000
    scale = kernel.WIDTH * np.sqrt(width)
    model = kernel.Classifier(
        np.zeros(width), np.ones(width), rng.standard_normal((width, n)) / scale, rng.uniform(0, 2 * np.pi, n), np.zeros(n + 1), np.zeros(1), np.zeros(1)
    )
    a, b = rng.uniform(-2, 2, (2, 1, width))
    product = (model.features(a)[:, :-1] @ model.features(b)[:, :-1].T).item()
    assert abs(product - np.exp(-((a - b) ** 2).sum() / (2 * scale**2))) < 0.02


def brute_isotonic(y, w):
    """The rising fit by its min-max form."""
    return [
        max(min(np.average(y[i : j + 1], weights=w[i : j + 1]) for j in range(k, len(y))) for i in range(k + 1)) for k in range(len(y))
    ]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 5)), min_size=1, max_size=12))
def test_isotonic_fit(rows):
    y, w = np.array([t / 5 for t, _ in rows]), np.array([n for _, n in rows], float)
    x = np.arange(len(rows), dtype=float)
    places, values = kernel.isotonic(x, y * w, w)
    assert (np.diff(places) > 0).all() and (np.diff(values) > 0).all()
    want = brute_isotonic(y, w)
    assert np.allclose(sorted(set(np.round(want, 9))), values)


def test_equal_means_are_one_pool():
    w = np.array([1.0, 1.0, 5.0, 1.0])
    places, values = kernel.isotonic(np.arange(4.0), np.array([0.0, 0.2, 0.2, 0.2]) * w, w)
    assert len(places) == 2 and np.allclose(values, [0.0, 0.2])


@pytest.mark.parametrize("text", ["", " " * 100_000, "a" * 2_000_000, "\n" * 100_000, "2016 2017 " * 100_000, "漢字🙂", "| | |"])
def test_statistics_are_defined(text):
    found = kernel.statistics(text.encode())
    assert len(found) == len(kernel.STATISTICS) and np.isfinite(found).all()
