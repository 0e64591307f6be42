import random
from collections import defaultdict

from pyspark.sql import functions as F

from earshot.llm import packing


def brute(pieces, capacity):
    """Every compatible bin looked at for every piece."""
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [
            (b["room"], n) for n, b in enumerate(bins)
            if b["room"] >= size and (source is None or source not in b["sources"])
            and (cluster is None or cluster not in b["clusters"])
        ]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        out.append((n, capacity - bins[n]["room"]))
        bins[n]["room"] -= size
        bins[n]["sources"].add(source)
        bins[n]["clusters"].add(cluster)
    return out


def test_block_equals_brute_force():
    rng = random.Random(1)
    pieces = sorted(
        ((rng.randint(1, 100), rng.choice(["a"] * 5 + list("bcdefgh") + [None]), rng.choice([None, *range(40)])) for _ in range(700)),
        key=lambda p: -p[0],
    )
    assert packing.pack_block(pieces, 100) == brute(pieces, 100)


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        if r["bin"] is not None:
            bins[r["block"], r["bin"]].append(r)
    for members in bins.values():
        members.sort(key=lambda r: r["start"])
        assert members[0]["start"] == 0
        for a, b in zip(members, members[1:]):
            assert a["start"] + a["size"] == b["start"]
        assert members[-1]["start"] + members[-1]["size"] <= capacity
        for name in ("source", "cluster"):
            named = [r[name] for r in members if r[name] is not None]
            assert len(named) == len(set(named))


def test_query_is_whole_and_free_of_conflicts(spark, sf_dir, doc_rows):
    from earshot.llm.queries import op9_best_fit

    rows = [r.asDict() for r in op9_best_fit(spark, sf_dir).collect()]
    check(rows, packing.CAPACITY)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["doc_id"]] += r["size"]
    assert sizes == {i: len(d.text.encode().split()) for i, d in doc_rows.items()}


def test_blocks_equal_brute_force(docs):
    rows = [r.asDict() for r in packing.packed_documents(docs, capacity=300, block=50).collect()]
    check(rows, 300)
    blocks = defaultdict(list)
    for r in rows:
        if r["block"] is not None:
            blocks[r["block"]].append(r)
    assert len(blocks) > 3
    for members in blocks.values():
        members.sort(key=lambda r: (-r["size"], r["doc_id"], r["piece"]))
        want = brute([(r["size"], r["source"], r["cluster"]) for r in members], 300)
        assert [(r["bin"], r["start"]) for r in members] == want


def test_odd_rows(odd_docs, no_docs):
    rows = [r.asDict() for r in packing.packed_documents(odd_docs, capacity=1000).collect()]
    check(rows, 1000)
    assert sum(r["size"] for r in rows if r["doc_id"] == 4) == 60_000
    assert [r["bin"] for r in rows if r["doc_id"] in (1, 2, 3)] == [None] * 3
    assert sum(r["doc_id"] is None for r in rows) == 2 and sum(r["doc_id"] == 6 for r in rows) == 2
    assert packing.packed_documents(no_docs).count() == 0


def test_same_bins_however_the_rows_are_stored(docs):
    a = packing.packed_documents(docs.repartition(3), capacity=300, block=64)
    b = packing.packed_documents(docs.orderBy(F.desc("doc_id")), capacity=300, block=64)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sequences_hold_every_word(spark, odd_docs):
    rows = [r.asDict() for r in packing.packed_documents(odd_docs, capacity=1000).collect()]
    assert all(len(r["text"].encode().split()) == r["size"] for r in rows)
    pieces = sorted((r for r in rows if r["doc_id"] == 4), key=lambda r: r["piece"])
    assert "".join(r["text"] for r in pieces) == " ".join(f"word{i % 5000}" for i in range(60_000))
    assert [r["text"] for r in rows if r["doc_id"] is None and r["size"]] == ["no id at all"]
    bins = defaultdict(list)
    for r in rows:
        if r["bin"] is not None:
            bins[r["block"], r["bin"]].append(r)
    for members in bins.values():
        words = " ".join(r["text"] for r in sorted(members, key=lambda r: r["start"])).encode().split()
        assert len(words) == sum(r["size"] for r in members) <= 1000


def test_pieces_put_together_are_the_text(spark):
    rng = random.Random(4)
    texts = ["", " ", "\n\t ", "one", "first line\n\tsecond  line\n\nthird", "  lead and tail \n", "\u00a0no\u2003blank"]
    for _ in range(150):
        texts.append("".join(rng.choice(["a", "bc", "\u6f22", "\U0001f642", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x85"]) for _ in range(rng.randrange(60))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    back = defaultdict(str)
    for r in sorted(packing.packed_documents(df, capacity=4, block=16).collect(), key=lambda r: (r.doc_id, r.piece)):
        assert len(r.text.encode().split()) == r["size"] <= 4
        back[r.doc_id] += r.text
    assert [back[i] for i in range(len(texts))] == texts


def test_rows_without_ids_and_repeated_rows_do_not_depend_on_storage(spark):
    rows = [(None, f"{i % 3} words of {i % 5}", f"s{i % 2}") for i in range(60)] + [(7, "same words", "s0")] * 40 + [(None, "x", None)] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    other = spark.createDataFrame(rows[::-1], df.schema).repartition(7)
    a, b = (sorted(map(repr, packing.packed_documents(d, capacity=8, block=16).collect())) for d in (df, other))
    assert len(a) == len(rows) and a == b


def test_equal_rows_fill_many_blocks(spark):
    df = spark.range(20_000).selectExpr("cast(null as long) as doc_id", "'the same text' as text", "'hot' as source")
    rows = packing.packed_documents(df, capacity=16, block=512)
    per_block = rows.groupBy("block").count().toPandas()["count"]
    assert len(per_block) == -(-20_000 // 512) and per_block.max() < 2 * 512 and per_block.sum() == 20_000
    assert rows.filter("start > 0").count() == 0


def test_a_text_of_blanks_takes_little_time(spark):
    import time

    df = spark.createDataFrame([(1, "a" + " " * 1_000_000 + "b", "s"), (2, " " * 1_000_000, "s")], "doc_id long, text string, source string")
    start = time.time()
    assert sorted((r.doc_id, r["size"]) for r in packing.packed_documents(df, capacity=1).collect()) == [(1, 1), (1, 1), (2, 0)]
    assert time.time() - start < 30
