"""Quality rules of documents and of the hosts they come from, in DataFrame functions only.

Every document is measured; documents that fail the rules are counted per host; the
failure rates are shrunk towards the mean of all hosts; documents of a host whose rate
stays above the limit go with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import MAX_BROADCAST_ROWS, at_most, let, text_of, words_of, wrapped
from earshot.sources import storage

# Words of a window whose repetition counts.
WINDOW = 5
MIN_WORDS = 10
# Share of repeated words, in percent.
MAX_REPEATED = 20
SYMBOLS = "[#*$%&|<>]"
# A host goes when more than this share of its documents is expected to fail.
MAX_FAILURES = 0.5
# Prior strength when the hosts differ no more than chance would have them.
STRONGEST_PRIOR = 1e6

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more.

    The windows are sorted with their places, so equal ones are neighbours; the places
    left are sorted again and each adds what the one before has not covered.
    """
    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda at, j: F.least(F.lit(WINDOW), at - F.coalesce(F.get(places, j - 1), at - WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def neighbours(order: Column) -> Column:
        return F.filter(
            order,
            lambda w, j: F.coalesce(w["h"] == F.get(order, j - 1)["h"], F.lit(False))
            | F.coalesce(w["h"] == F.get(order, j + 1)["h"], F.lit(False)),
        )

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    starts = let(F.sort_array(placed), lambda order: F.transform(neighbours(order), lambda w: w["at"]))
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), let(F.sort_array(starts), covered)
    ).otherwise(0)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` wrapped as ``row``, with the five measures, all long, and ``base_failed``.

    A missing text has no words and fails. Two windows count as equal when their chained
    64-bit hashes are (one false match in 10^11 texts of 20,000 words).
    """
    words, lines = F.col("_words"), F.split(F.col("_text"), "\n", -1)
    cut = wrapped(df, _text=text_of(f"`{text}`")).withColumn("_words", words_of(F.col("_text")))
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    windows = F.when(
        F.size(words) >= WINDOW,
        F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    full_lines = F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measures = cut.select(
        "row",
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(full_lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    ).withColumn("n_repeat_words", _repeated_words(F.col("_windows")).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return measures.select("row", *MEASURES, failed.alias("base_failed"))


def host_rates(judged: DataFrame) -> DataFrame:
    """Per ``host``: ``n_docs``, ``n_failed`` and the shrunk ``rate``. Documents without a host form none.

    The prior is the beta distribution with the mean of all documents and the variance
    between hosts that is left after that of chance. Runs one job, for its two numbers.
    """
    hosts = storage.written(
        judged.filter(F.col("host").isNotNull()).groupBy("host").agg(
            F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed")
        ),
        "hosts",
    )
    sums = hosts.agg(
        F.count("*").alias("k"), F.sum("n_docs").alias("m"), F.sum("n_failed").alias("f"),
        F.sum(F.col("n_failed") * F.col("n_failed") / F.col("n_docs")).alias("squares"),
    ).head()
    mean, strength = _prior(sums["k"], sums["m"] or 0, sums["f"] or 0, sums["squares"] or 0.0)
    return hosts.withColumn("rate", (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength))


def _prior(hosts: int, docs: int, failed: int, squares: float) -> tuple[float, float]:
    """Mean and strength of the beta prior. ``squares``: the sum of failed^2 / docs over the hosts."""
    if not docs:
        return 0.0, STRONGEST_PRIOR
    mean = failed / docs
    chance = mean * (1 - mean)
    between = squares / docs - mean * mean - chance * hosts / docs
    if between <= 0 or chance <= 0:
        return mean, STRONGEST_PRIOR
    return mean, min(STRONGEST_PRIOR, max(1.0, chance / between - 1))


def verdicts(judged: DataFrame, max_failures: float = MAX_FAILURES) -> DataFrame:
    """Adds ``kept`` to rows with ``host`` and ``base_failed``, which should be a written table: it is read twice.

    The rejected hosts are broadcast after their rows and bytes were counted; if they are too many, they
    are joined, and adaptive execution splits the rows of a large host.
    """
    rejected = storage.written(
        host_rates(judged).filter(F.col("rate") > max_failures).select("host", F.lit(True).alias("_rejected")),
        "rejected-hosts",
    )
    joined = judged.join(at_most(rejected, MAX_BROADCAST_ROWS), "host", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("_rejected").isNull()).drop("_rejected")


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (the columns of ``keep``, or all), the measures, ``base_failed``, ``kept``.

    Nulls: a missing text is empty and fails; a document without a host is judged by its
    own rules only. Repeated rows count as often as they occur; an empty table gives none.
    The measured rows are written to the shared folder once, and read for the hosts and
    for the verdicts.
    """
    rows = measured(docs, text)
    rows = rows.withColumn("host", F.col("row").getField(host).cast("string"))
    if keep is not None:
        rows = rows.withColumn("row", F.struct(*[F.col("row").getField(c).alias(c) for c in keep]))
    return verdicts(storage.written(rows, "judged"))
