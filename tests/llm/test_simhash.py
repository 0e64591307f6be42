import random

import pytest
import xxhash
from pyspark.sql import functions as F

from earshot.llm import components, simhash


def brute_fp(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_query_equals_brute_force(spark, sf_dir, doc_rows):
    from earshot.llm.queries import op10_simhash

    ids = sorted(doc_rows)
    fps = [brute_fp(doc_rows[i].text) for i in ids]
    labels = brute_components(fps, 2)
    want = {(i, f"{fp:016x}", ids[label]) for i, fp, label in zip(ids, fps, labels)}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in op10_simhash(spark, sf_dir).collect()} == want
    assert len(set(labels)) < len(ids)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_keep_every_component(spark, distance):
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for base in list(fps):  # chains of near ones, a dense ball, and ones just too far
        for _ in range(12):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.add(base)
    ball = rng.getrandbits(64)
    fps |= {ball ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    stars = {r.u: r.v for r in components.roots(simhash.links(simhash.postings(df, distance), distance)).collect()}
    label = [stars.get(s, s) for s in signed]
    want = brute_components(fps, distance)
    pairs = set(zip(label, want))
    assert len(pairs) == len(set(label)) == len(set(want))


def test_long_chain_settles(spark):
    df = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {(r.u, r.v) for r in components.roots(df).collect()} == {(i, 0) for i in range(1, 301)}


def test_odd_rows(odd_docs, no_docs):
    out = simhash.near_duplicates(odd_docs)
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fp == by_id[2].fp == by_id[3].fp == 0
    assert by_id[3].component_id == 1 and by_id[6].component_id == 5
    assert sorted(r.component_id for r in rows if r.doc_id is None and r.fp == 0) == [1]
    # Only a component of rows without ids has no name.
    assert [r.component_id for r in rows if r.doc_id is None and r.fp] == [None]
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.first_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 8, 9, 10]
    assert kept.filter("doc_id is null").count() == 2


def test_fingerprint_edges():
    for text in ("", " ", "a", "A b", "a b c", "a b c d", "É à Ü x y z", "one two three"):
        assert simhash.fingerprint(text.encode()) == brute_fp(text)
    many = " ".join(str(i * i % 9973) for i in range(70_000))
    assert simhash.fingerprint(many.encode()) == brute_fp(many)


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(60)) for name in "abcd")
    rows = [(1, a), (7, a), (7, b), (8, b), (7, c), (9, d), (9, d), (None, a), (None, "x y z"), (None, "x y z"), (None, None), (None, "")]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        kept = sorted(map(tuple, simhash.first_of_each(docs).collect()), key=str)
        wordless = [r for r in kept if r[0] is None and not r[1]]
        assert len(wordless) == 1
        kept.remove(wordless[0])
        assert kept == sorted([(1, a), (7, b), (7, c), (9, d), (None, "x y z")], key=str)
