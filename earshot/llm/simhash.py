"""Near duplicates by SimHash fingerprints within a few bits of each other.

The index is by bytes at their positions. Two fingerprints of eight bytes that differ in
at most ``d`` bits agree in at least ``8 - d`` bytes where they stand: that number is the
guaranteed minimum of matches. A posting list of the index is made for each set of that
many positional bytes, so any pair that meets in one has reached the count, and the lists
stay short where those of single bytes would each hold a 256th of all documents. Within a
list only the free bytes can differ; partners are looked up by flipping up to ``d`` of
those bits, which takes a number of steps in proportion to the list, never its square.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm import components
from earshot.llm.common import text_of, unwrapped, wrapped
from earshot.sources import storage

SHINGLE = 3
MAX_DISTANCE = 2
HASH_SEED = 42
BYTES = 8
# Shingles whose bits are counted in one go.
CHUNK = 1 << 16
# Lists up to this length compare each member with the others; beyond it flips are cheaper.
SHORT_LIST = 12


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The majority of each bit over the hashes of all shingles of a text in UTF-8; 0 without words."""
    words = text.lower().split()  # A-Z and the six blanks: bytes know no others
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(words) - width + 1]
    ends = np.concatenate((gaps, [len(joined)]))[width - 1 :]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in spans], dtype=">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, BYTES), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > len(starts)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` (long) and ``fp``, the fingerprint as a signed long. A missing text is empty."""

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, width) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _keyed_fingerprints(rows: DataFrame, width: int) -> DataFrame:
    """The other columns of ``rows`` and ``fp``, the fingerprint of the text in ``row``."""
    kept = rows.drop("row")

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*names, "fp"])

    names = kept.columns
    schema = ", ".join(f"{c} {kind}" for c, kind in kept.dtypes) + ", fp long"
    return rows.select(*names, text_of("row.text").alias("text")).mapInArrow(run, schema)


def _kept_positions(distance: int) -> list[tuple[int, ...]]:
    if not 0 <= distance < BYTES:
        raise ValueError(f"the distance must be 0 to {BYTES - 1}, is {distance}")
    return list(combinations(range(BYTES), BYTES - distance))


def _mask(positions) -> int:
    return int(np.uint64(sum(0xFF << (8 * p) for p in positions)).view(np.int64))


def postings(fps: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """The posting lists with two members or more: ``list`` (which positions), ``key`` (their bytes), ``members``.

    ``fps`` holds each fingerprint once, so a list of ``8 - d`` bytes has at most 256^d members.
    """
    keys = F.array(*[
        F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("key"))
        for i, p in enumerate(_kept_positions(distance))
    ])
    entries = fps.select("fp", F.explode(keys).alias("at"))
    lists = entries.groupBy("at.list", "at.key").agg(F.collect_list("fp").alias("members"))
    return lists.filter(F.size("members") > 1)


def _flips(free: tuple[int, ...], distance: int) -> np.ndarray:
    """All ways to change up to ``distance`` bits of the free bytes."""
    bits = [8 * p + b for p in free for b in range(8)]
    chosen = (c for n in range(1, distance + 1) for c in combinations(bits, n))
    return np.array([sum(1 << b for b in c) for c in chosen], np.uint64)


def _verified(members: np.ndarray, flips: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted ``members`` of pairs within the distance, the smaller first."""
    if len(members) <= SHORT_LIST:
        left, right = np.triu_indices(len(members), 1)
    else:
        left, right = [], []
        for flip in flips:
            other = members ^ flip
            at = np.minimum(np.searchsorted(members, other), len(members) - 1)
            hit = np.flatnonzero((members[at] == other) & (members < other))
            left.append(hit)
            right.append(at[hit])
        left, right = np.concatenate(left), np.concatenate(right)
    differing = members[left] ^ members[right]
    # The tally of the positional bytes shared, then the bits themselves.
    shared = (differing[:, None].view(np.uint8) == 0).sum(axis=1)
    near = (shared >= BYTES - distance) & (np.bitwise_count(differing) <= distance)
    return left[near], right[near]


def _contracted(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest place that each place is linked to, directly or not."""
    label = np.arange(size)
    while True:
        before = label.copy()
        least = np.minimum(label[left], label[right])
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def links(lists: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``u``, ``v``: verified links of each list, contracted to one link per member, which keeps what is connected."""
    flips = [
        _flips(tuple(set(range(BYTES)) - set(p)), distance) for p in _kept_positions(distance)
    ]

    def run(batches):
        for batch in batches:
            us, vs = [], []
            for which, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                members = np.sort(np.array(members, np.int64).view(np.uint64))
                left, right = _verified(members, flips[which], distance)
                if len(left):
                    label = _contracted(len(members), left, right)
                    inner = np.flatnonzero(label != np.arange(len(members)))
                    us.append(members[inner])
                    vs.append(members[label[inner]])
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"]
                )

    return lists.select("list", "members").mapInArrow(run, "u long, v long")


def _rooted(firsts: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """``firsts``, which hold each ``fp`` once, with the ``root`` of its component; the links of those not alone."""
    stars = components.roots(links(postings(firsts.select("fp"), distance), distance))
    labelled = firsts.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    return labelled.withColumn("root", F.coalesce("root", "fp")), stars


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, distance: int = MAX_DISTANCE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id``: the smallest id reachable over links of at most ``distance`` bits.

    Equal fingerprints meet first, so any number of copies is one entry of the index. A
    missing or wordless text has fingerprint 0 and is linked like any other. A row without
    an id belongs to its component and never names it (a component of such rows only has
    none); repeated rows come out as often as they went in.
    """
    found = storage.written(fingerprints(docs, width, text, doc_id), "fingerprints")
    firsts = storage.written(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    labelled, stars = _rooted(firsts, distance)
    # Only components of two fingerprints or more need naming again.
    names = (
        labelled.join(stars.select(F.col("v").alias("root")).distinct(), "root", "left_semi")
        .groupBy("root").agg(F.min("first_id").alias("component_id"))
    )
    classes = labelled.join(names, "root", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")
    )
    return found.join(classes, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, width: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """The first document of each component; columns as given.

    The order is by id, rows without one last, then by fingerprint, then by hashes of the
    text and of the other columns: rows with one id and different texts are each judged by
    their own component, and of equal rows one stays. Rows with neither an id nor a word
    are copies of each other only.
    """
    # Maps have no hash; rows that differ in nothing else count as equal.
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    key = {
        "_unnamed": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
        "_text_hash": F.xxhash64(text_of()), "_row_hash": F.xxhash64(*hashed),
    }
    rows = wrapped(docs, **key)
    found = storage.written(_keyed_fingerprints(rows, width), "fingerprints")
    apart, first = F.col("_unnamed") & (F.col("fp") == 0), F.struct("_unnamed", "_id", "fp", "_text_hash", "_row_hash")
    # By fingerprint first: any number of copies is one row of the index.
    firsts = storage.written(
        found.groupBy("fp").agg(F.min(F.when(~apart, first)).alias("first"), F.min(F.when(apart, first)).alias("apart")),
        "distinct-fingerprints",
    )
    per_root = _rooted(firsts, distance)[0].groupBy("root").agg(F.min("first").alias("first")).select("first")
    chosen = per_root.unionByName(firsts.select(F.col("apart").alias("first"))).filter("first is not null")
    # Equal rows meet before the join, which then needs no shuffle of its own for them.
    return unwrapped(rows.dropDuplicates(list(key)).join(chosen.select("first.*").drop("fp"), list(key)))
