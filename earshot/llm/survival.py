"""Filter interaction audit: what each filter removes, in every order of the filters, from one pass.

A document that fails some of five filters survives a subset of them when it fails none in
it. All 32 answers of a document are one 32-bit word, a row of the truth table of its
failures. Carry-save adders count the words of a part and label bit by bit: bit S of the
sum is the number of documents that survive the subset S. Every order and step then is a
difference of two such counts, so the documents are read once, whatever the number of orders.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import sliced, text_of
from earshot.sources import storage

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
FULL = SUBSETS - 1
MIN_WORDS = 50
# In percent: the least share of distinct words, and the largest of capitals.
MIN_DISTINCT, MAX_CAPITALS = 65, 5
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
# Bit S of word f: whether a document with the failures f survives the subset S.
TRUTH = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], np.uint32)
# What is counted: all documents, and those of each label.
LABELS = ("all", "good", "toxic")
# Parts whose counts a task holds before it passes them on, under 1 KB each.
PARTS_HELD = 4096


def failures(text: bytes, n_points: int) -> int:
    """Bits 0 to 3: whether a text fails the filters A to D."""
    words = text.split()  # the six blanks: bytes know no others
    n = len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (n < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT * n) << 1
        | (100 * capitals > MAX_CAPITALS * n_points) << 2
        | (len(text.translate(None, _SYMBOLS)) < len(text)) << 3
    )


def marked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source") -> DataFrame:
    """``doc_id`` (long), ``part``, ``failed`` (bits 0 to 3) and ``digest`` (SHA-256 of the text); a missing text is empty."""

    def run(batches):
        for batch in sliced(batches):
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            points = pc.utf8_length(batch.column(2)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([failures(t, n) for t, n in zip(texts, points)], pa.int32()),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                ],
                names=["doc_id", "part", "failed", "digest"],
            )

    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{part}`").cast("string").alias("part"),
        text_of(f"`{text}`").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, part string, failed int, digest binary")


def with_copies(marks: DataFrame) -> DataFrame:
    """Adds bit 4 of ``failed``: whether the text stands under a smaller id anywhere. Reads ``marks`` twice.

    Only digests that occur more than once are joined; adaptive execution splits the rows of
    a large group. A row without an id fails nothing here and makes no other row fail.
    """
    firsts = (
        marks.filter("doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    )
    copy = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False)).cast("int")
    return marks.join(firsts, "digest", "left").withColumn("failed", F.col("failed") + 16 * copy).drop("_first", "digest")


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set.

    A full adder takes three words of one weight to a sum of that weight and a carry of the
    next, for all 32 positions at once; what is left of a weight is fewer than three words.
    """
    counts, bits, weight = np.zeros(32, np.int64), np.arange(32, dtype=np.uint32), 0
    while len(words):
        carries = []
        while len(words) >= 3:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * n :]))
        for word in words:
            counts += ((word >> bits) & 1).astype(np.int64) << weight
        words = np.concatenate(carries) if carries else words[:0]
        weight += 1
    return counts


def survivors(failed: DataFrame) -> DataFrame:
    """``part`` and, per label, an array of 32 counts: the documents that survive each subset of the filters.

    ``failed`` has ``part``, ``failed`` (bits 0 to 4), and the booleans ``good`` and ``toxic``.
    A task passes on one row per part.
    """

    def told(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([c.ravel() for c in held.values()], pa.list_(pa.int64()))],
            names=["part", "counts"],
        )

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            order = np.argsort(codes.indices.to_numpy(zero_copy_only=False), kind="stable")
            words = TRUTH[batch.column(1).to_numpy(zero_copy_only=False)[order]]
            labels = [batch.column(i).to_numpy(zero_copy_only=False).astype(bool)[order] for i in (2, 3)]
            ends = np.cumsum(np.bincount(codes.indices.to_numpy(zero_copy_only=False), minlength=len(codes.dictionary)))
            start = 0
            for part, end in zip(codes.dictionary.to_pylist(), ends.tolist()):
                own = words[start:end]
                picked = [own, *(own[label[start:end]] for label in labels)]
                counts = np.stack([positional_counts(p) for p in picked])
                held[part] = held[part] + counts if part in held else counts
                start = end
            if len(held) > PARTS_HELD:
                yield told(held)
                held = {}
        if held:
            yield told(held)

    counted = failed.select("part", "failed", "good", "toxic").mapInArrow(run, "part string, counts array<long>")
    sums = counted.groupBy("part").agg(
        F.array(*[F.sum(F.get("counts", F.lit(i))) for i in range(len(LABELS) * SUBSETS)]).alias("counts")
    )
    return sums.select("part", *[F.slice("counts", i * SUBSETS + 1, SUBSETS).alias(name) for i, name in enumerate(LABELS)])


def _shapley(alive: Column, bit: int) -> Column:
    """The documents a filter removes, summed over all orders: each subset before it stands in so many orders."""
    total = F.lit(0).cast("long")
    for before in range(SUBSETS):
        if not before & bit:
            size = before.bit_count()
            weight = factorial(size) * factorial(len(FILTERS) - 1 - size)
            total = total + weight * (F.get(alive, F.lit(before)) - F.get(alive, F.lit(before | bit)))
    return total


def by_order(alive: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`survivors`: 600 rows a part."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    shapley = F.array(*[_shapley(F.col("all"), 1 << i) for i in range(len(FILTERS))])
    rows = (
        alive.withColumn("_shapley", shapley)
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    )

    def subset(letters: Column) -> Column:
        bits = [F.when(F.instr(letters, x) > 0, 1 << i).otherwise(0) for i, x in enumerate(FILTERS)]
        return sum(bits[1:], bits[0])

    before = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    rows = rows.withColumn("_before", subset(before)).withColumn("_bit", subset(letter))
    rows = rows.withColumn("_after", F.col("_before") + F.col("_bit"))

    def lost(label: str) -> Column:
        return F.get(label, "_before") - F.get(label, "_after")

    failing = F.get("all", F.lit(0)) - F.get("all", "_bit")
    return rows.select(
        "part", "filter_order", "step", F.get("all", "_after").alias("kept"), lost("all").alias("removed"),
        (failing - lost("all")).alias("redundant"),
        (F.get("all", FULL - F.col("_bit")) - F.get("all", F.lit(FULL))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
        F.get("_shapley", (F.instr(F.lit(FILTERS), letter) - 1)).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of :func:`by_order` for the documents of each source.

    Nulls: a missing text is empty, a missing source the part ``''``; a document without an
    id has no label and is no copy. Repeated rows count as often as they occur; two rows
    with one id and text are no copies of each other. An id with several rows of labels has
    each label that one of them has. An empty table gives no rows. The measured rows,
    without their texts, are written to the shared folder once.
    """
    marks = storage.written(marked(docs), "marks")
    found = (
        labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    known = with_copies(marks).join(found, "doc_id", "left").fillna(False, ["good", "toxic"])
    return by_order(survivors(known))
