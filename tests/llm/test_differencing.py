import random
import zlib
from collections import defaultdict

import pytest

from earshot.llm import differencing
from earshot.llm.queries import op8_differencing


def spread(sizes, shards, where):
    sums = [0] * shards
    for size, shard in zip(sizes, where):
        sums[shard] += size
    return max(sums) - min(sums)


@pytest.mark.parametrize("shards", [1, 2, 3, 24])
def test_difference_is_whole_and_tighter_than_greedy(shards):
    rng = random.Random(shards)
    sizes = [int(rng.lognormvariate(8, 1)) + 1 for _ in range(2000)]
    parts = [tuple([s] + [0] * (shards - 1)) for s in sizes]
    bins, went = differencing.difference(parts, shards)
    where = [w[0] for w in went]
    sums = [0] * shards
    for size, shard in zip(sizes, where):
        sums[shard] += size
    assert sums == bins and sorted(bins, reverse=True) == bins
    assert all(sorted(w) == list(range(shards)) for w in went)
    if shards > 1:
        greedy, sums = [], [0] * shards
        for size in sorted(sizes, reverse=True):
            greedy.append(sums.index(min(sums)))
            sums[greedy[-1]] += size
        assert spread(sizes, shards, where) <= max(sums) - min(sums)


def test_known_two_way_differencing():
    # 8 and 7 leave 1, 6 and 5 leave 1, then 4 - 1, 3 - 1: the textbook's spread of 2.
    bins, _ = differencing.difference([(s, 0) for s in (8, 7, 6, 5, 4)], 2)
    assert bins == [16, 14]


def check(rows, texts, shards):
    shard_of, sums, slots = {}, [0] * shards, defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
        sums[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for taken in slots.values():
        assert sorted(taken) == list(range(len(taken)))
    return sums


def test_query_is_whole_and_even(spark, sf_dir, doc_rows):
    rows = [r.asDict() for r in op8_differencing(spark, sf_dir).collect()]
    assert len(rows) == len(doc_rows)
    sums = check(rows, {i: d.text for i, d in doc_rows.items()}, 24)
    groups = defaultdict(int)
    for r in rows:
        groups[doc_rows[r["doc_id"]].text] += r["size"]
    assert max(sums) - min(sums) <= max(groups.values())


@pytest.mark.parametrize("block", [2, 7, 60])
def test_levels(spark, block):
    rng = random.Random(block)
    sizes = {k: rng.randint(1, 1000) for k in range(400)}
    df = spark.createDataFrame(list(sizes.items()), "key long, size long")
    found = {r.key: r.shard for r in differencing.assign(df, 5, block).collect()} if block > 2 else {
        r.key: r.shard for r in differencing.assign(df.limit(20), 5, block).collect()
    }
    assert set(found) <= set(sizes) and len(found) == (400 if block > 2 else 20)
    assert set(found.values()) == set(range(5))
    if block == 60:
        assert spread([sizes[k] for k in found], 5, list(found.values())) <= 20


def test_odd_rows(spark, odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in odd_docs.filter("doc_id is not null").collect()}
    out = differencing.shard(odd_docs, slot_rows=3)
    rows = [r.asDict() for r in out.collect()]
    assert len(rows) == odd_docs.count()
    named = [r for r in rows if r["doc_id"] is not None]
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["shard"] for r in named if not texts[r["doc_id"]]} == {named[0]["shard"]} or len(
        {r["shard"] for r in named if not texts[r["doc_id"]]}
    ) == 1
    assert len({r["shard"] for r in named if r["doc_id"] in (5, 6)}) == 1
    assert differencing.shard(no_docs).count() == 0
