import re

from pyspark.sql import functions as F

from earshot.llm import hosts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {
        w for w in set(windows) if windows.count(w) > 1
    }
    covered = {i + k for i, w in enumerate(windows) if w in repeated for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup, "n_repeat_words": len(covered),
    }


def test_measures_equal_brute_force(docs, doc_rows):
    found = hosts.measured(docs).select("row.doc_id", *hosts.MEASURES).collect()
    assert len(found) == len(doc_rows)
    for r in found:
        if len(doc_rows[r.doc_id].text or "") < 20_000:
            assert {k: r[k] for k in hosts.MEASURES} == brute(doc_rows[r.doc_id].text)


def test_repeated_windows(spark):
    texts = ["a b c d e " * 2, "a b c d e f a b c d e", "a a a a a a", "a a a a a", "x " * 4, "\n a \n a \n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in hosts.measured(df).select("row.doc_id", *hosts.MEASURES).collect():
        assert {k: r[k] for k in hosts.MEASURES} == brute(texts[r.doc_id])


def test_a_host_that_mostly_fails_takes_its_documents_along(spark):
    good, bad = " ".join(f"w{i}" for i in range(50)), "too short"
    rows = [(i, bad if i % 10 else good, "spam") for i in range(100)]
    rows += [(100 + i, good if i % 20 else bad, f"host{i % 7}") for i in range(210)]
    rows += [(400, bad, "one"), (401, good, "other"), (402, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in hosts.judge(df).filter("kept").select("row.doc_id").collect()}
    assert not kept & set(range(100))  # the good ones of the bad host too
    assert kept >= {100 + i for i in range(210) if i % 20} | {401, 402}


def test_prior():
    assert hosts._prior(0, 0, 0, 0.0) == (0.0, hosts.STRONGEST_PRIOR)
    # Hosts that differ no more than chance lend each other everything.
    assert hosts._prior(2, 20, 10, 5.0)[1] == hosts.STRONGEST_PRIOR
    mean, strength = hosts._prior(2, 200, 100, 90.0**2 / 100 + 10.0**2 / 100)
    assert mean == 0.5 and 1 <= strength < 10


def test_odd_rows(odd_docs, no_docs):
    out = hosts.judge(odd_docs)
    assert out.count() == odd_docs.count()
    first = out.filter("row.doc_id = 1").first()
    assert first.n_words == 0 and first.base_failed and not first.kept
    long_one = out.filter("row.doc_id = 4").first()
    assert long_one.n_words == 60_000 and long_one.n_repeat_words == 60_000
    assert out.select("row.*").columns == odd_docs.columns
    assert hosts.judge(no_docs).count() == 0


def test_rejected_hosts_join_the_same_way_when_they_are_many(docs, monkeypatch):
    judged = hosts.measured(docs).withColumn("host", F.col("row.source")).withColumn("base_failed", F.col("row.source").isin("src1", "src2"))
    some = [r.kept for r in hosts.verdicts(judged).orderBy("row.doc_id").collect()]
    monkeypatch.setattr(hosts, "MAX_BROADCAST_ROWS", -1)
    assert [r.kept for r in hosts.verdicts(judged).orderBy("row.doc_id").collect()] == some
    assert len(set(some)) == 2


def test_a_text_of_blanks_takes_little_time(spark):
    import time

    texts = ["a" + " " * 1_000_000 + "b", " " * 1_000_000, "a" * 1_000_000, " \n" * 500_000]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    start = time.time()
    assert sorted((r.row.doc_id, r.n_words) for r in hosts.measured(df).collect()) == [(0, 2), (1, 0), (2, 1), (3, 0)]
    assert time.time() - start < 30
