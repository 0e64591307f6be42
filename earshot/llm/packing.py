"""Best-fit packing of documents into training sequences, with conflicts.

A bin never holds two pieces of one source or of one cluster of duplicates. Bins are kept
in order of the room that is left; the search starts at the tightest bin that a piece fits
into and goes on to its successors until one has neither the piece's source nor its
cluster in its bitmaps.

The pieces are dealt into blocks by a hash, and every block is packed in one task: a source
or cluster of any size, and any number of equal rows, is spread over all blocks, and what a
task holds depends on the block size alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import BLANK, LETTER, MAX_BROADCAST_ROWS, text_of, wrapped
from earshot.sources import storage

CAPACITY = 2048
# Pieces of one task: at most a few MB, with bins enough that the last ones hardly count.
BLOCK = 4096
# Bytes of text of one task on average.
BLOCK_BYTES = 64 << 20


class _Bins:
    """Open bins in order of the room left, each with the bitmaps of its sources and clusters."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []
        self.room: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def tightest(self, size: int, source: int, cluster: int) -> int | None:
        """Place in ``open`` of the tightest compatible bin; of equally tight ones the oldest."""
        for at in range(bisect_left(self.open, (size, -1)), len(self.open)):
            number = self.open[at][1]
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                return at
        return None

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the place in it of a new piece."""
        at = self.tightest(size, source, cluster)
        if at is None:
            number = len(self.room)
            self.room.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        else:
            number = self.open.pop(at)[1]
        start = self.capacity - self.room[number]
        self.room[number] -= size
        self.sources[number] |= source
        self.clusters[number] |= cluster
        if self.room[number]:
            insort(self.open, (self.room[number], number))
        return number, start


def _bit(seen: dict, value) -> int:
    """The value's bit within the block; none for a missing value, which conflicts with nothing."""
    return 0 if value is None else 1 << seen.setdefault(value, len(seen))


def pack_block(pieces, capacity: int) -> list[tuple[int, int]]:
    """Bin and start of each ``(size, source, cluster)``, which come largest first."""
    bins, sources, clusters = _Bins(capacity), {}, {}
    return [bins.put(size, _bit(sources, source), _bit(clusters, cluster)) for size, source, cluster in pieces]


def pieces_of(text: Column, n_words: Column, capacity: int) -> Column:
    """Slices of a text with ``capacity`` words each, the last with the rest; put together they are the text.

    A slice ends where the next one's first word begins; a text without a word is one slice.
    """
    # Each element is a word with the blanks behind it, but for blanks before the first word.
    parts = F.split(text, f"(?<={BLANK})(?={LETTER})", -1)
    lead = F.when(text.rlike(f"^{BLANK}"), 1).otherwise(0)

    def cut(x: Column) -> Column:
        last = F.ceil(n_words / capacity).cast("int") - 1

        def one(i: Column) -> Column:
            first = F.when(i == 0, 1).otherwise(i * capacity + 1 + x["lead"])
            return F.array_join(F.slice(x["parts"], first, F.when(i == 0, capacity + x["lead"]).otherwise(capacity)), "")

        return F.transform(F.sequence(F.lit(0), last), one)

    longer = F.transform(F.array(F.struct(parts.alias("parts"), lead.alias("lead"))), cut)[0]
    return F.when(n_words > capacity, longer).otherwise(F.array(text))


def _spread(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``_copy``, the number of each among the pieces equal to it; 0 for most.

    A hash of the whole row tells which may be equal; those are grouped, and one of each group
    is repeated as often as there were, so no task has to number them. Runs a job.
    """
    counts = storage.written(
        pieces.groupBy("_same").agg(F.count("*").alias("_n")).filter("_n > 1"), "equal-pieces"
    )
    n = counts.count()
    if not n:
        return pieces.withColumn("_copy", F.lit(0).cast("long"))
    known = pieces.join(F.broadcast(counts) if n <= MAX_BROADCAST_ROWS else counts, "_same", "left")
    single = known.filter("_n is null").drop("_n").withColumn("_copy", F.lit(0).cast("long"))
    names = [c for c in pieces.columns if c != "_same"]
    equal = known.filter("_n is not null").groupBy("_same", *names).agg(F.count("*").alias("_n"))
    return single.unionByName(equal.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n"))


def pack(
    df: DataFrame, size: Column, source: Column, cluster: Column, doc_id: str = "doc_id",
    capacity: int = CAPACITY, block: int = BLOCK, texts: Column | None = None,
) -> DataFrame:
    """``doc_id``, ``piece``, ``size`` (long), ``source``, ``cluster``, ``block``, ``bin``, ``start`` (long).

    With ``texts``, an array with the text of every piece, also ``text``. The rows of one bin
    in the order of ``start`` are a training sequence.

    A row of more than ``capacity`` is cut into pieces of that length and a rest; the pieces
    of one row share its source, so they lie in different bins. Rows of size 0 or less take
    no place and have null ``bin`` and ``start``, in one piece. A missing source or cluster
    conflicts with nothing. Equal sizes are placed in the order of ids, then of pieces,
    clusters, sources and texts, so the result does not depend on how the rows were stored;
    repeated rows are packed as often as they occur, dealt over the blocks like others. An
    empty table gives no rows. Runs two jobs, to count the pieces and the equal ones.
    """
    if capacity < 1 or block < 1:
        raise ValueError("capacity and block must be positive")
    length = F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0))
    rows = wrapped(df, doc_id=F.col(f"`{doc_id}`"), _length=length, source=source.cast("string"), cluster=cluster.cast("string"),
                   _texts=F.lit(None).cast("array<string>") if texts is None else texts).drop("row")
    whole = F.greatest(F.ceil(F.col("_length") / capacity), F.lit(1))
    if texts is None:
        cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)))
    else:
        cut = rows.select("doc_id", "_length", "source", "cluster", F.posexplode("_texts").alias("piece", "text"))
    carried = [] if texts is None else ["text"]
    columns = ["doc_id", "piece", "size", "source", "cluster", *carried]
    pieces = storage.written(
        cut.withColumn("piece", F.col("piece").cast("long"))
        .withColumn("size", F.least(F.col("_length") - F.col("piece") * capacity, F.lit(capacity)).cast("long"))
        .select(*columns, F.xxhash64(*columns).alias("_same")),
        "pieces",
    )
    n_bytes = F.sum(F.octet_length("text")) if carried else F.lit(0)
    n, total = pieces.filter("size > 0").agg(F.count("*"), n_bytes).head()
    blocks = max(1, -(-n // block), -(-(total or 0) // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("doc_id", "piece", "cluster", "_copy"), F.lit(blocks)).cast("long")
    dealt = _spread(pieces.filter("size > 0")).withColumn("block", place).drop("_same", "_copy")

    names = [*columns, "block"]
    order = ["doc_id", "piece", "cluster", "source", *carried]

    def packed(table: pa.Table) -> pa.Table:
        table = table.select(names)
        table = table.sort_by([("size", "descending"), *((c, "ascending") for c in order)])
        placed = pack_block(zip(*(table[c].to_pylist() for c in ("size", "source", "cluster"))), capacity)
        for i, name in enumerate(("bin", "start")):
            table = table.append_column(name, pa.array([p[i] for p in placed], pa.int64()))
        return table

    kind = dict(df.dtypes)[doc_id]
    text_kind = ", text string" if carried else ""
    schema = f"doc_id {kind}, piece long, size long, source string, cluster string{text_kind}, block long, bin long, start long"
    final = ["doc_id", "piece", "size", "source", "cluster", "block", "bin", "start", *carried]
    filled = dealt.groupBy("block").applyInArrow(packed, schema)
    empty = pieces.filter("size <= 0").select(
        *columns, *[F.lit(None).cast("long").alias(c) for c in ("block", "bin", "start")]
    )
    return filled.unionByName(empty).select(*final)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """:func:`pack` for documents, with their text: a word is a token, ``source`` the source, equal texts a cluster.

    The pieces of a document are slices of its text, blanks and line breaks included: put
    together in their order they are the text.
    """
    n_words = F.regexp_count(text_of(), F.lit(f"{LETTER}+"))
    return pack(
        docs, n_words, F.col("source"), F.sha2(text_of(), 256), capacity=capacity, block=block,
        texts=pieces_of(text_of(), n_words, capacity),
    )
