"""Fill-in-the-middle examples: a text cut in three and put together in another order.

The cuts are given in units (characters, or words) from the left. A rolling hash cuts the
UTF-8 text into chunks where its content says so, so a passage that many documents share
is cut alike in all of them. What a chunk holds, its units and how it begins and ends, is
kept in a content cache, where a chunk is found by its bytes; sums over the chunks of a
document tell which chunk a cut lies in, and only that one is looked into.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import sliced, text_of

MARKS = ("<P>", "<S>", "<M>")
# Of 100: texts that are cut, and of those the ones told suffix first.
CUT, SUFFIX_FIRST = 90, 20
# Bytes of a chunk: at least, at most, and the mask that ends one on average after a KB more.
LEAST, MOST, MASK = 256, 8192, np.uint32(0x3FF << 22)
# Bytes of chunks that a worker remembers; two generations are kept.
REMEMBERED_BYTES = 16 << 20
# A number for every byte, by rule.
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 0) for b in range(256)], np.uint32)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def rolling(data: np.ndarray) -> np.ndarray:
    """Per byte, a hash of it and the 31 before it: each byte's number, doubled for every byte that follows."""
    found = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        if len(found) <= width:
            break
        longer = found.copy()
        longer[width:] += found[:-width] << np.uint32(width)
        found = longer
    return found


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end: behind a byte whose hash has the mask's bits zero, or where one is too long."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    candidates = np.flatnonzero(rolling(data) & MASK == 0) + 1
    ends, at = [], 0
    while n - at > LEAST:
        i = np.searchsorted(candidates, at + LEAST)
        end = int(candidates[i]) if i < len(candidates) else n
        at = min(end, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


class Chars:
    """Units are code points; one begins at each byte that continues none."""

    @staticmethod
    def starts(data: np.ndarray) -> np.ndarray:
        return np.flatnonzero((data & 0xC0) != 0x80)

    @classmethod
    def summary(cls, data: np.ndarray) -> tuple[int, bool, bool]:
        return int(np.count_nonzero((data & 0xC0) != 0x80)), False, False


class Words:
    """Units are words, each with the blanks behind it; blanks before the first belong to it."""

    @staticmethod
    def starts(data: np.ndarray) -> np.ndarray:
        blank = _BLANK[data]
        return np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))

    @classmethod
    def summary(cls, data: np.ndarray) -> tuple[int, bool, bool]:
        """Words, and whether the chunk begins and ends inside or at the edge of one."""
        return len(cls.starts(data)), not _BLANK[data[0]], not _BLANK[data[-1]]


UNITS = {"chars": Chars, "words": Words}


class ChunkCache:
    """Summaries of the chunks met lately, by their bytes: a hash finds one, its content confirms it."""

    def __init__(self, unit, limit: int = REMEMBERED_BYTES) -> None:
        self.unit, self.limit, self.held = unit, limit, 0
        self.known, self.older = {}, {}
        self.hits = 0

    def __getitem__(self, chunk: bytes) -> tuple[int, bool, bool]:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.older.get(chunk)
        if found is None:
            found = self.unit.summary(np.frombuffer(chunk, np.uint8))
        else:
            self.hits += 1
        self.held += len(chunk)
        if self.held > self.limit:
            self.older, self.known, self.held = self.known, {}, len(chunk)
        self.known[chunk] = found
        return found


class Cuts:
    """Units and cuts of one text, from the summaries of its chunks."""

    def __init__(self, text: bytes, cache: ChunkCache) -> None:
        self.text, self.unit = text, cache.unit
        self.data = np.frombuffer(text, np.uint8)
        self.ends = chunk_ends(self.data)
        self.starts = [0, *self.ends[:-1]]
        counts, self.joined, inside = [], [], False
        for start, end in zip(self.starts, self.ends):
            n, begins, ends = cache[text[start:end]]
            # A word that goes on from the chunk before has been counted there.
            self.joined.append(inside and begins)
            counts.append(n - self.joined[-1])
            inside = ends
        self.upto = np.array([0, *accumulate(counts)], np.int64)

    @property
    def n(self) -> int:
        return int(self.upto[-1])

    def offset(self, units: int) -> int:
        """The byte at which the unit after the first ``units`` begins; the text's length where there is none."""
        if units >= self.n:
            return len(self.text)
        if units <= 0:
            return 0
        at = int(np.searchsorted(self.upto, units, side="right")) - 1
        start = self.starts[at]
        inner = self.unit.starts(self.data[start : self.ends[at]])
        return start + int(inner[units - int(self.upto[at]) + self.joined[at]])


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 that depend on the seed and the document's id alone; a missing id is an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def rearranged(text: bytes, doc_id, cache: ChunkCache, seed: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, units of prefix and middle, and the new text."""
    cuts = Cuts(text, cache)
    n, (h1, h2, h3, h4) = cuts.n, draws(doc_id, seed)
    prefix, suffix, middle = (m.encode() for m in MARKS)
    if not text or h3 % 100 >= CUT or prefix in text or suffix in text or middle in text:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = cuts.offset(first), cuts.offset(second)
    if h4 % 100 < SUFFIX_FIRST:
        form, out = "spm", (suffix, text[b:], prefix, text[:a], middle, text[a:b])
    else:
        form, out = "psm", (prefix, text[:a], suffix, text[b:], middle, text[a:b])
    return n, form, first, second - first, b"".join(out)


def fill_in_middle(
    docs: DataFrame, seed: int = 1, unit: str = "chars", text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id``, ``n`` (long), ``form``, ``prefix_units``, ``middle_units`` (long), ``output``.

    Nulls: a missing text is empty and stays plain; a row without an id draws as one with an
    empty id. A text that is empty or holds a mark is plain. Rows are rewritten where they
    lie, so repeated rows come out repeated and an empty table stays empty.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}, is {unit!r}")

    def run(batches):
        cache = ChunkCache(UNITS[unit])
        for batch in sliced(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = [rearranged(t, d, cache, seed) for d, t in zip(batch.column(0).to_pylist(), texts)]
            n, form, first, second, output = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()), pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_units", "middle_units", "output"],
            )

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(f"`{text}`").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_units long, middle_units long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    pieces = F.split(output, "|".join(MARKS), -1)
    back = F.when(form == "psm", F.concat(F.get(pieces, F.lit(1)), F.get(pieces, F.lit(3)), F.get(pieces, F.lit(2))))
    return back.when(form == "spm", F.concat(F.get(pieces, F.lit(2)), F.get(pieces, F.lit(3)), F.get(pieces, F.lit(1)))).otherwise(output)
