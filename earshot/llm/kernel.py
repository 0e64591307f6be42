"""Quality scores of documents: a Gaussian kernel over document statistics, approximated by random features.

Every text becomes a short vector of statistics. Cosines of random projections of it have,
in expectation, products equal to a Gaussian kernel, so ridge regression on them is kernel
regression whose normal equations have a fixed size: partitions add up their own and only
the sums meet. The raw scores are then calibrated by isotonic regression on labelled rows
that were left out of the fit.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import sliced, text_of
from earshot.sources import storage

FEATURES = 384
SEED = 17
# Width of the kernel, in standard deviations of one statistic times the root of their number.
WIDTH = 1.0
# Share of the labelled rows that the ridge penalty counts as.
RIDGE = 1e-3
# Statistics are clipped at so many standard deviations.
CLIP = 4.0
# Labelled rows that are learnt from, at most in expectation: of more, a part chosen by a hash of the id.
MAX_LABELLED = 200_000
# One labelled row of so many is left out of the fit, for the calibration.
CALIBRATION = 4
# Raw scores are told apart to so many steps in the calibration.
STEPS = 4096
# Labelled rows of one partition of normal equations.
ROWS_PER_SUM = 4096

_BLANKS = b" \t\n\x0b\x0c\r"
_CAPITALS = bytes(range(0x41, 0x5B))
_SMALL = bytes(range(0x61, 0x7B))
_DIGITS = b"0123456789"
_ENDS = b".!?"
_MARKS = b"#$%&*|<>{}[]\\^~=_@+/"
_OTHER_MARKS = b"\"'(),-:;`"
_END_SET, _MARK_SET = set(_ENDS), set(_MARKS)

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "longest_word", "short_words", "distinct_words", "top_word", "same_as_last",
    "repeated_triples", "word_entropy", "capitals", "digits", "ends", "exclamations", "marks", "other_marks", "bars", "wide",
    "words_ending_sentences", "words_ending_in_marks", "capital_words", "log_lines", "words_a_line", "short_lines", "repeated_lines",
    "lines_ending_sentences", "byte_entropy", "compressed",
)


def _entropy(counts) -> float:
    p = np.asarray(counts, float)
    p = p[p > 0] / max(1.0, p.sum())
    return float(-(p * np.log2(p)).sum())


def statistics(text: bytes) -> list[float]:
    """The numbers named in :data:`STATISTICS`; all are defined for a text without a word."""
    words, n_bytes = text.split(), len(text)
    n, size = len(words), max(1, n_bytes)
    some = max(1, n)
    counts = Counter(words)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if n_bytes else np.zeros(256, np.int64)

    def share(of: bytes) -> float:
        return int(seen[list(of)].sum()) / size

    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in text.split(b"\n") if line.strip(_BLANKS)]
    n_lines = max(1, len(lines))
    spread = np.array([line.count(b" ") + 1 for line in lines] or [0])
    lasts = bytes(w[-1] for w in words)
    triples = n - 2
    repeated = triples - len(set(zip(words, words[1:], words[2:]))) if triples > 0 else 0
    return [
        math.log1p(n_bytes), math.log1p(n), float(lengths.sum()) / some, math.log1p(int(lengths.max(initial=0))),
        int((lengths <= 3).sum()) / some, len(counts) / some, max(counts.values(), default=0) / some,
        sum(a == b for a, b in zip(words, words[1:])) / some, repeated / some,
        _entropy(list(counts.values())) / math.log2(n + 1) if n else 0.0,
        share(_CAPITALS) / max(1e-9, share(_CAPITALS) + share(_SMALL)), share(_DIGITS), share(_ENDS), share(b"!"), share(_MARKS),
        share(_OTHER_MARKS), share(b"|"), int(seen[0x80:].sum()) / size,
        sum(c in _END_SET for c in lasts) / some, sum(c in _MARK_SET for c in lasts) / some,
        sum(w.isupper() for w in words) / some, math.log1p(len(lines)), math.log1p(n / n_lines), int((spread < 4).sum()) / n_lines,
        1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(line.rstrip(_BLANKS)[-1] in _END_SET for line in lines) / n_lines,
        _entropy(seen), len(zlib.compress(text, 1)) / (size + 16),
    ]


def measured(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``stats``, the statistics of the whole text; a missing one is empty."""

    def run(batches):
        for batch in sliced(batches):
            found = [statistics(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float32()))], names=["doc_id", "stats"]
            )

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {kind}, stats array<float>"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), len(STATISTICS))


@dataclass(frozen=True)
class Classifier:
    """What a fit leaves: scales of the statistics, projections, weights, and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    projections: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines of the projections, and a one."""
        scaled = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.cos(scaled @ self.projections + self.shifts) * math.sqrt(2 / len(self.shifts))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw_scores(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Between 0 and 1."""
        return np.clip(np.interp(self.raw_scores(stats), self.raw, self.calibrated), 0.0, 1.0)


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the best rising fit: neighbouring ``x`` whose means fall are pooled.

    ``total`` and ``weight`` are the sums of the targets and the numbers of rows at each
    ``x``, which ascend. A pool stands at the mean place of its rows.
    """
    pools: list[list[float]] = []
    for place, t, w in zip(x, total, weight):
        pools.append([place * w, t, w])
        # Means that differ by rounding alone are equal.
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= (right := pools[-1][1] * pools[-2][2]) - 1e-12 * abs(right):
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    places, totals, weights = np.array(pools).T
    return places / weights, totals / weights


def normal_equations(rows: DataFrame, model: Classifier) -> np.ndarray:
    """Sums of the products of the features with each other and, in the last column, with ``label``.

    A partition adds up its own and passes on one row per feature; the rows of a feature
    are added up in turn. What comes back has a fixed size.
    """
    width = len(model.shifts) + 1

    def run(batches):
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = model.features(_matrix(batch.column(0)))
            total += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"]
        )

    def added(table: pa.Table) -> pa.Table:
        parts = np.stack([np.asarray(s) for s in table["sums"].to_pylist()])
        # In one order whatever came first, so that a fit can be repeated.
        parts = parts[np.lexsort(parts.T[::-1])]
        return pa.table({"i": table["i"][:1], "sums": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})

    partial = rows.select("stats", "label").mapInArrow(run, "i int, sums array<double>")
    summed = partial.groupBy("i").applyInArrow(added, "i int, sums array<double>").collect()
    out = np.zeros((width, width + 1))
    for r in summed:
        out[r.i] = r.sums
    return out


def sample(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id``, ``label`` of the labelled ids; of more than ``most`` ids a part chosen by a hash, about so many.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1; others are left out). An id with several
    rows has their mean.
    """
    known = (
        labels.filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id").agg(F.avg(F.col("label").cast("double")).alias("label"))
    )
    n, steps = known.count(), 1 << 30
    if n <= most:
        return known
    return known.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(steps)) < int(steps * most / n))


def fit(stats: DataFrame, labels: DataFrame, seed: int = SEED, features: int = FEATURES, most: int = MAX_LABELLED) -> Classifier:
    """Learns from the rows of ``stats`` whose id is in ``labels``, at most about ``most`` of them.

    A few jobs on the sample; to the driver come the moments of the statistics, the normal
    equations and one row per step of the scores, all of fixed size. Without a labelled row
    every score is one half; with one class only, that class's share.
    """
    # The sample is bounded: it is broadcast, and the statistics stay where they are.
    learnt = stats.join(F.broadcast(sample(labels, most)), "doc_id")
    rows = storage.written(
        learnt.select(
            "stats", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0).alias("held"),
            F.xxhash64("doc_id", "stats").alias("order"),
        ),
        "labelled",
    )
    width = len(STATISTICS)
    entry = [F.get("stats", F.lit(i)).cast("double") for i in range(width)]
    n, moments = (lambda r: (r[0], np.array(r[1:], float)))(
        rows.agg(F.count("*"), *[F.avg(e) for e in entry], *[F.stddev_pop(e) for e in entry]).head()
    )
    drawn = np.random.default_rng(seed)
    projections = drawn.standard_normal((width, features)) / (WIDTH * math.sqrt(width))
    shifts = drawn.uniform(0, 2 * math.pi, features)
    if not n:
        zeros = np.zeros(width)
        return Classifier(zeros, zeros + 1, projections, shifts, np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    mean, scale = moments[:width], moments[width:]
    scale = np.where(scale > 1e-9, scale, 1.0)
    plain = Classifier(mean, scale, projections, shifts, np.zeros(features + 1), np.zeros(1), np.zeros(1))

    parts = max(1, -(-n // ROWS_PER_SUM))
    dealt = rows.filter("not held").repartition(parts, "order").sortWithinPartitions("order")
    sums = normal_equations(dealt, plain)
    penalty = np.full(features + 1, RIDGE * max(1.0, sums[-1, -2]))
    penalty[-1] = 1e-9 * max(1.0, sums[-1, -2])  # the constant is not shrunk
    weights = np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1])
    model = Classifier(mean, scale, projections, shifts, weights, np.zeros(1), np.zeros(1))

    def run(batches):
        for batch in batches:
            step = np.round(model.raw_scores(_matrix(batch.column(0))) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(step, -STEPS, 2 * STEPS)), batch.column(1)], names=["step", "label"])

    # The rows left out of the fit; where there are none, those of the fit.
    held = rows.filter("held") if rows.filter("held").head(1) else rows
    found = (
        held.select("stats", "label").mapInArrow(run, "step long, label double")
        .groupBy("step").agg(F.sum("label").alias("total"), F.count("*").alias("n")).orderBy("step").collect()
    )
    raw, calibrated = isotonic(*(np.array([r[i] for r in found], float) for i in range(3)))
    return Classifier(mean, scale, projections, shifts, weights, raw / STEPS, calibrated)


def scored(stats: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id``, ``score`` of the rows of :func:`measured`."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                scores = model.scores(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")


def quality(docs: DataFrame, labels: DataFrame, learn: Column, most: int = MAX_LABELLED) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from one half on) of every document.

    ``labels`` has ``doc_id`` and ``quality``; rows for which ``learn``, a condition on
    ``doc_id``, does not hold teach nothing. Nulls: a missing text is empty, and scored; a
    document without an id is scored and teaches nothing; a label that is neither 0 nor 1 is
    none. Repeated rows are scored alike and teach as often as they occur. An empty table
    gives no rows. The statistics are written to the shared folder once.
    """
    stats = storage.written(measured(docs), "statistics")
    known = labels.filter(learn).select(F.col("doc_id"), F.col("quality").alias("label"))
    model = fit(stats, known, most=most)
    return scored(stats, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
