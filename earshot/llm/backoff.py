"""Scores of texts under a weighted backoff automaton of smoothed n-grams.

States are the histories that training saw, arcs the n-grams that continue them. A state
without an arc for the next token is left by its failure arc for the state of the history
one word shorter, down to the root, which knows every token. One pass over a text carries
the state and adds up the weights.

The n-grams of all texts are counted by blocks: each task lists the n-grams of its block of
texts once, as sorted runs of 64-bit keys; runs of one key range meet in one task, which
adds up the training counts and answers every block with the totals of its keys, in order.
A block thus gets the part of the automaton that its texts can reach, and nobody ever holds
the whole. Key ranges are even whatever the texts say: a frequent word is one key of a run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import sliced, text_of
from earshot.sources import storage

ORDER = 2
# Weight of the shorter history, in observations, against what a history has seen itself.
PSEUDO_COUNT = 5.0
# Text whose n-grams go into one key range, and text of a block, in bytes.
RANGE_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
# Tokens a task gathers before it lists their n-grams.
GATHERED = 4_500_000

_MASK = (1 << 64) - 1
# No word has a blank in it.
_END_KEY, _START_KEY = (xxhash.xxh64_intdigest(s) for s in (b"\n", b" "))


def token_keys(text: bytes) -> np.ndarray:
    """Keys of the words of a text in UTF-8, lower-cased A to Z, and of the end."""
    words = text.lower().split()
    keys = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return np.append(keys, np.uint64(_END_KEY))


def _joined(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of their first n - 1 tokens and their last."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + (last ^ (last >> np.uint64(31)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def ngram_keys(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """For 1 to ``order``, the key of the n-gram that ends at each token; texts begin with a start."""
    grams, start = [tokens], np.uint64(_START_KEY)
    padded = np.concatenate(([start], tokens))
    keys = padded
    for _ in range(order - 1):
        # Before a text there is nothing but starts.
        keys = np.concatenate(([start], _joined(keys[:-1], padded[1:])))
        grams.append(keys[1:])
    return grams


def file_block(docs: DataFrame, doc_id: str = "doc_id") -> Column:
    """Block of a row that is read from a file: rows of one split are together, in parts of about a block's size."""
    split = docs.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")
    parts = max(1, -(-_bytes(split) // BLOCK_BYTES))
    part = F.pmod(F.xxhash64(doc_id), F.lit(parts))
    return F.abs(F.xxhash64(F.input_file_name(), F.input_file_block_start(), part) % (1 << 62))


def _bytes(setting: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    digits = setting.lower().rstrip("b").rstrip("kmgt")
    unit = setting.lower().rstrip("b")[len(digits) :]
    return int(digits) << units.get(unit[:1], 0)


# Numbers travel as bytes, as many for each as the largest needs.
_RUN = "range int, block long, order int, n int, keys binary, counts binary"
_TOTAL = "range int, block long, order int, n int, totals binary"
_SUMS = -1


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, not negative, each in as many low bytes as the largest has."""
    width = -(-int(values.max(initial=0)).bit_length() // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    if n:
        wide[:, : len(data) // n] = np.frombuffer(data, np.uint8).reshape(n, -1)
    return wide.view("<u8").ravel()


def steps_of(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as the first and the steps to the next: smaller numbers."""
    return np.diff(keys, prepend=np.uint64(0))


def runs(docs: DataFrame, order: int, ranges: int) -> DataFrame:
    """Sorted runs of the distinct n-gram keys of each block, with how often training has each.

    ``docs`` has ``block``, ``held_out`` and ``text``. A block may come in several runs.
    """
    starts = (np.arange(ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64)
    edges = starts[1:]

    def listed(block: int, gathered: list) -> list[pa.RecordBatch]:
        out = []
        for n in range(order):
            every = np.unique(np.concatenate([grams[n] for grams, _ in gathered]))
            trained = [grams[n] for grams, held_out in gathered if not held_out]
            counts = np.zeros(len(every), np.int32)
            if trained:
                keys, times = np.unique(np.concatenate(trained), return_counts=True)
                counts[np.searchsorted(every, keys)] = times
            bounds = [0, *np.searchsorted(every, edges).tolist(), len(every)]
            full = [(r, a, b) for r, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
            out.append(pa.RecordBatch.from_arrays(
                [
                    pa.array([r for r, _, _ in full], pa.int32()), pa.array([block] * len(full), pa.int64()),
                    pa.array([n + 1] * len(full), pa.int32()), pa.array([b - a for _, a, b in full], pa.int32()),
                    # The first key of a range counts from where the range begins.
                    pa.array([packed(steps_of(every[a:b] - starts[r])) for r, a, b in full], pa.binary()),
                    pa.array([packed(counts[a:b]) for _, a, b in full], pa.binary()),
                ],
                names=["range", "block", "order", "n", "keys", "counts"],
            ))
        return out

    def run(batches):
        gathered, tokens = {}, 0
        for batch in sliced(batches):
            for block, held_out, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()
            ):
                keys = token_keys(text)
                tokens += len(keys)
                gathered.setdefault(block, []).append((ngram_keys(keys, order), held_out))
                if tokens >= GATHERED:
                    for b in list(gathered):
                        yield from listed(b, gathered.pop(b))
                    tokens = 0
        for b in list(gathered):
            yield from listed(b, gathered.pop(b))

    return docs.select("block", "held_out", "text").mapInArrow(run, _RUN)


def totals(listed: DataFrame) -> DataFrame:
    """Per run of a block (all its runs of one range together) the training counts of its keys, in their order.

    Rows of block -1 have, per range and order: the n-grams that training has, their
    tokens, and the n-grams it has once.
    """

    def run(table: pa.Table) -> pa.Table:
        number = table["range"][0].as_py()
        rows = {"range": [], "block": [], "order": [], "n": [], "totals": []}

        def add(block: int, n: int, values: np.ndarray) -> None:
            for name, value in zip(rows, (number, block, n, len(values), packed(values))):
                rows[name].append(value)

        orders = np.array(table["order"])
        for n in np.unique(orders).tolist():
            own = table.take(np.flatnonzero(orders == n))
            lengths = own["n"].to_pylist()
            # Places of keys count from where the range begins, which orders them alike.
            keys = np.concatenate([np.cumsum(unpacked(k, m), dtype=np.uint64) for k, m in zip(own["keys"].to_pylist(), lengths)])
            counts = np.concatenate([unpacked(c, m) for c, m in zip(own["counts"].to_pylist(), lengths)])
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            distinct, place = np.unique(keys, return_inverse=True)
            del keys
            sums = np.bincount(place, counts, len(distinct)).astype(np.int64)
            add(_SUMS, n, np.array([np.count_nonzero(sums), sums.sum(), np.count_nonzero(sums == 1)]))
            of_block: dict[int, list[int]] = {}
            for i, block in enumerate(own["block"].to_pylist()):
                of_block.setdefault(block, []).append(i)
            for block, those in of_block.items():
                places = [place[bounds[i] : bounds[i + 1]] for i in those]
                add(block, n, sums[places[0] if len(places) == 1 else np.unique(np.concatenate(places))])
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(rows.items(), kinds)})

    return listed.groupBy("range").applyInArrow(run, _TOTAL)


class Automaton:
    """The part of the automaton that some texts can reach.

    ``root`` has the weight of each token at the root. For every longer history, ``arcs``
    has the weight of each n-gram and ``fails`` that of the failure arc of its history; an
    n-gram that training lacks has no arc (NaN).
    """

    def __init__(self, root: np.ndarray, arcs: list[np.ndarray], fails: list[np.ndarray]) -> None:
        self.root, self.arcs, self.fails = root, arcs, fails

    def traverse(self, grams: list[np.ndarray]) -> float:
        """The sum of weights along a text, given the numbers of its n-grams for each length, shortest first.

        At each token the state is the longest history; where it has no arc for the token,
        its failure arc is taken, and so on down to the root.
        """
        total, roots = 0.0, self.root[grams[0]].tolist()
        levels = [(arc[g].tolist(), fail[g].tolist()) for arc, fail, g in zip(self.arcs, self.fails, grams[1:])][::-1]
        if len(levels) == 1:  # the usual case, without the loop over lengths
            for root, weight, fail in zip(roots, *levels[0]):
                total += weight if weight == weight else fail + root
            return total
        for t, root in enumerate(roots):
            for arc, fail in levels:
                weight = arc[t]
                if weight == weight:
                    total += weight
                    break
                total += fail[t]
            else:
                total += root
        return total


def smoothing(tokens: int, once: int, history: np.ndarray) -> np.ndarray:
    """Share of the probability that a history leaves to the shorter one.

    In the long run it is what Good and Turing give to the unseen, the n-grams seen once; a
    history seen rarely leaves more. It depends on the history alone, so the probabilities
    of all next tokens add up to one.
    """
    floor = once / tokens if tokens else 1.0
    return (floor * history + PSEUDO_COUNT) / (history + PSEUDO_COUNT)


def weigh(counts: list[np.ndarray], histories: list[np.ndarray], shorter: list[np.ndarray], model: dict) -> Automaton:
    """Weights from training counts of distinct n-grams.

    Of each order: ``counts``; from the second on, ``histories``, the counts of their
    histories, and ``shorter``, the numbers of the n-grams one token shorter at the front.
    """
    seen, tokens, _ = model[1]
    probability = (counts[0] + 1) / (tokens + seen + 1)
    root, arcs, fails = np.log10(probability), [], []
    for n, (count, history, less) in enumerate(zip(counts[1:], histories, shorter), 2):
        left = smoothing(*model.get(n, (0, 0, 0))[1:], history)
        known = np.maximum(history, 1)
        probability = (1 - left) * count / known + left * probability[less]
        arcs.append(np.where(count > 0, np.log10(probability), np.nan))
        fails.append(np.log10(left))
    return Automaton(root, arcs, fails)


_SCORED = "doc_id {}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def scores(docs: DataFrame, answered: DataFrame, order: int, model: dict, trained: int) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score``, ``score``."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        lengths, of_order = [], [[] for _ in range(order)]
        for text in texts["text"].cast(pa.binary()).to_pylist():
            grams = ngram_keys(token_keys(text), order)
            lengths.append(len(grams[0]))
            for keys, all_keys in zip(grams, of_order):
                all_keys.append(keys)
        ends = np.cumsum(np.array(lengths, np.int64))
        starts = ends - lengths if len(lengths) else ends
        answers = answers.sort_by([("order", "ascending"), ("range", "ascending")])
        orders = np.array(answers["order"])
        counts, histories, shorter, numbers = [], [], [], []
        at_token = None
        for n in range(order):
            keys = np.concatenate(of_order[n]) if lengths else np.zeros(0, np.uint64)
            of_order[n] = None
            distinct, first, number = np.unique(keys, return_index=True, return_inverse=True)
            del keys
            own = answers.take(np.flatnonzero(orders == n + 1))
            parts = [unpacked(t, m) for t, m in zip(own["totals"].to_pylist(), own["n"].to_pylist())]
            count = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
            if len(count) != len(distinct):
                raise RuntimeError("a block changed between counting and scoring")
            if n:
                # The history of an n-gram stands one token before; before a text stands its start.
                history = np.concatenate(([0], at_token[:-1]))
                history[starts] = trained
                histories.append(history[first])
                shorter.append(numbers[-1][first])
            at_token = count[number]
            if n == 0:
                known = np.concatenate(([0], np.cumsum(at_token > 0)))
                n_known = known[ends] - known[starts]
            counts.append(count)
            numbers.append(number)
        automaton = weigh(counts, histories, shorter, model)
        base, total = [], []
        for start, end in zip(starts.tolist(), ends.tolist()):
            grams = [of[start:end] for of in numbers]
            base.append(float(automaton.root[grams[0]].sum()))
            total.append(automaton.traverse(grams))
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(total, pa.float64()),
        })

    kind = dict(docs.dtypes)["doc_id"]
    return docs.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, _SCORED.format(kind))


def _sums(answered: DataFrame) -> dict[int, tuple[int, int, int]]:
    """Per order what :func:`totals` has in the rows of block -1, added up over the ranges."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[n] = sums.get(n, 0) + unpacked(values, 3).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), *(pa.array([int(s[i]) for s in sums.values()], pa.int64()) for i in range(3))],
            names=["order", "seen", "tokens", "once"],
        )

    parts = answered.filter(F.col("block") == _SUMS).select("order", "totals").mapInArrow(
        run, "order int, seen long, tokens long, once long"
    )
    added = parts.groupBy("order").agg(*[F.sum(c) for c in ("seen", "tokens", "once")])
    return {r[0]: tuple(r[1:]) for r in added.collect()}  # one row per order


def score(docs: DataFrame, held_out: Column, block: Column | None = None, order: int = ORDER) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    ``docs`` has ``doc_id`` and ``text``. Rows where ``held_out`` is false (or null) train
    the model. Scores are log10 probabilities of all words and the end; the base is the
    root alone, with one added to every count. ``block`` puts a row into a block of
    bounded size and must give the same for it each time; by default it is a hash of the id.

    Nulls: a missing text is empty and has the end only; a missing id is an id like any
    other. Repeated rows are counted and scored as often as they occur. Without training
    rows every token has the probability 1 of the only class, the unknown. Runs jobs that
    size the table, count, and sum up.
    """
    if order < 2:
        raise ValueError("the order must be 2 or more")
    sizes = docs.agg(
        F.sum(F.octet_length(text_of())), F.count_if(~F.coalesce(held_out, F.lit(False)))
    ).head()
    n_bytes, trained = sizes[0] or 0, sizes[1]
    if block is None:
        block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-n_bytes // BLOCK_BYTES)))).cast("long")
    rows = docs.select(
        block.cast("long").alias("block"), "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
        text_of().alias("text"),
    )
    ranges = max(1, -(-n_bytes // RANGE_BYTES))
    answered = storage.written(totals(runs(rows, order, ranges)), "totals")
    model = _sums(answered)
    model.setdefault(1, (0, 0, 0))
    scored = scores(rows, answered.filter(F.col("block") != _SUMS), order, model, trained)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model[1][1]).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
