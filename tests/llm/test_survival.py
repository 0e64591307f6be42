from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from earshot.llm import survival

LABELS = "doc_id long, quality int, toxic int, text string"


def fails(text, smaller_copy):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
        "E": smaller_copy,
    }


def brute(docs, labels):
    """Every order applied to every document, filter by filter."""
    docs = [(i, t or "", s or "") for i, t, s in docs]
    known = {}
    for i, q, t in labels:
        if i is not None:
            good, toxic = known.get(i, (False, False))
            known[i] = (good or q == 1, toxic or t == 1)
    rows = {}
    for part in {s for _, _, s in docs}:
        own = [
            (fails(t, i is not None and any(j is not None and j < i and u == t for j, u, _ in docs)), *known.get(i, (False, False)))
            for i, t, s in docs if s == part
        ]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = own
            for step, x in enumerate(order):
                gone = [d for d in alive if d[0][x]]
                alive = [d for d in alive if not d[0][x]]
                shapley[x] += len(gone)
                rows[part, "".join(order), step + 1] = [
                    len(alive), len(gone), sum(d[0][x] for d in own) - len(gone),
                    sum(d[0][x] and sum(d[0].values()) == 1 for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone),
                ]
        for key in rows:
            if key[0] == part:
                rows[key].append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def told(df):
    rows = [tuple(r) for r in df.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    ).collect()]
    assert len({r[:3] for r in rows}) == len(rows)
    return {r[:3]: r[3:] for r in rows}


def test_small_table_equals_every_order_by_hand(spark):
    plain = " ".join(f"word{i}" for i in range(60))
    docs = [
        (1, plain, "a"), (2, plain, "a"), (3, plain, "b"), (3, plain, "b"), (3, plain, "a"), (None, plain, "a"), (4, "SHOUT", None),
        (5, "few words", "a"), (6, "same " * 80, "a"), (7, plain + " #", "b"), (8, plain.upper(), "b"), (9, None, ""), (10, "", "c"),
        (11, "same " * 80, "c"), (0, "few words", "c"), (12, "A B #", "c"), (13, "A B #", "c"), (None, None, None),
    ]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (5, None, 1), (8, 0, 1), (9, 1, None), (99, 1, 1), (None, 1, 1)]
    got = survival.audit(
        spark.createDataFrame(docs, "doc_id long, text string, source string"),
        spark.createDataFrame([r + ("clash",) for r in labels], LABELS),
    )
    assert told(got) == brute(docs, labels)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1, 0, None), (6, 1, 1, None)], LABELS)
    docs = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert told(survival.audit(odd_docs, labels)) == brute(docs, [(4, 1, 0), (6, 1, 1)])


def test_no_rows_and_no_labels(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], LABELS)
    assert survival.audit(no_docs, none).collect() == []
    rows = survival.audit(odd_docs, none).collect()
    assert rows and all(r.good_lost == r.toxic_lost == 0 for r in rows)


def test_removals_of_an_order_add_up(spark, docs):
    rows = survival.audit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet")).toPandas()
    whole = docs.groupBy("source").count().toPandas().set_index("source")["count"].to_dict()
    for (part, _), steps in rows.sort_values("step").groupby(["part", "filter_order"]):
        assert list(steps.step) == [1, 2, 3, 4, 5]
        assert whole[part] - steps.removed.cumsum().iloc[-1] == steps.kept.iloc[-1]
    assert (rows.groupby(["part", "filter_order"]).shapley.sum() == rows.groupby(["part", "filter_order"]).removed.sum() * 120).all()


def test_many_copies_and_parts(spark):
    text = " ".join(f"w{i}" for i in range(55))
    docs = spark.range(6000).selectExpr("id as doc_id", f"'{text}' as text", "cast(id % 5000 as string) as source")
    rows = survival.audit(docs, spark.createDataFrame([], LABELS))
    assert rows.count() == 5000 * 600
    first = rows.filter("part = '0' and filter_order = 'EABCD' and step = 1").head()
    assert (first.kept, first.removed) == (1, 1)
    assert rows.filter("filter_order = 'ABCDE' and step = 5").agg({"kept": "sum"}).head()[0] == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_adders_count_every_bit(words):
    want = [sum(w >> b & 1 for w in words) for b in range(32)]
    assert survival.positional_counts(np.array(words, np.uint32)).tolist() == want


@pytest.mark.parametrize("failed", range(32))
def test_words_are_the_truth_table(failed):
    assert [int(survival.TRUTH[failed]) >> s & 1 for s in range(32)] == [int(not failed & s) for s in range(32)]
