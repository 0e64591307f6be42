"""Token ids as files of length-delimited binary records, with an offset index beside them.

A record is: the payload's length (8 bytes, little-endian), the masked CRC-32 of those
eight bytes, the payload, its masked CRC-32, and one newline byte. The payload is the
document's id, whether it has one, the bytes per token id (2 where all fit, else 4), and
the ids, little-endian. The newline is what Spark's writer puts after a row, so that Spark
lays down, commits and reads the files in any file system it knows; a task that is lost
leaves nothing behind that counts.

Files follow each other in ascending order of documents, and each is in that order.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import merges
from earshot.llm.common import prefix_sums, sliced, text_of
from earshot.sources import storage

# Of the record format: the constant of the mask, and the bytes around a payload.
MASK = 0xA282EAD8
HEAD, TAIL = 12, 5
FRAME = HEAD + TAIL
END = b"\n"
_LEAD = "<q??"
_LEAD_BYTES = struct.calcsize(_LEAD)
# Text that goes into one file, in bytes; a file is read whole by one task.
FILE_BYTES = 8 << 20
# Rows that are encoded together.
TOGETHER = 4000


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    """The record without its newline."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return struct.pack(_LEAD, doc_id or 0, doc_id is not None, wide) + ids.astype("<u4" if wide else "<u2").tobytes()


def read_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, has_id, wide = struct.unpack_from(_LEAD, payload)
    return doc_id if has_id else None, np.frombuffer(payload, "<u4" if wide else "<u2", offset=_LEAD_BYTES)


def length_at(data: bytes, offset: int) -> int:
    """Length of the payload of the record at ``offset``, against its checksum."""
    head = data[offset : offset + HEAD]
    if len(head) < HEAD or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError(f"no record begins at {offset}")
    return struct.unpack("<Q", head[:8])[0]


def payload_at(data: bytes, offset: int) -> bytes:
    """Payload of the record at ``offset``, against both checksums."""
    at = offset + HEAD
    payload = data[at : at + length_at(data, offset)]
    tail = data[at + len(payload) : at + len(payload) + TAIL]
    if tail != struct.pack("<I", masked(payload)) + END:
        raise ValueError(f"the record at {offset} does not fit its checksum")
    return payload


def offsets(data: bytes):
    """Where the records of a file begin."""
    at = 0
    while at < len(data):
        yield at
        at += FRAME + length_at(data, at)


def write(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, file_bytes: int = FILE_BYTES) -> str:
    """Encodes every document, with ``end_id`` after it, into files below ``path``; returns the folder.

    ``docs`` has ``doc_id`` and ``text`` (a missing one is empty). Rows without an id come
    first; rows with one id stay in the order of their texts' hashes, each with a record of its own. The
    texts are dealt out by ranges of ids before they are encoded, so ids are never shuffled.
    An empty table gives files without a record and an empty index.
    """
    spark = docs.sparkSession
    path = path or storage.fresh_path(spark, "records")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + FRAME)).head()[0] or 0
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(max(1, -(-total // file_bytes)), *order).sortWithinPartitions(*order)

    def run(batches):
        vocab = merges.load(vocabulary)
        end = np.array([end_id], "<u4")
        # A task has the text of one file; the more of it at once, the fewer words are looked up again.
        for batch in sliced(batches, TOGETHER):
            ids = vocab.encoded_all(batch.column(1).to_pylist())
            records = [
                framed(payload_of(doc_id, np.concatenate((own, end)))) for doc_id, own in zip(batch.column(0).to_pylist(), ids)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    written = dealt.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    # One file per part, whatever the session says: the parts' numbers are the files' order.
    written.write.option("compression", "none").option("lineSep", END.decode()).option("maxRecordsPerFile", 0).text(
        f"{path}/records"
    )
    _write_index(spark, path)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, the number of the file in the order of documents, and its whole ``content``."""
    number = F.regexp_extract("path", r"part-([0-9]+)-", 1).cast("long")
    return spark.read.format("binaryFile").load(f"{path}/records").select(number.alias("file"), "content")


def _write_index(spark: SparkSession, path: str) -> None:
    """Reads every file back, once: each record is held against its checksums, and its ids get one of their own."""

    def run(batches):
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, out, start = content.as_buffer().to_pybytes(), [], 0
                for at in offsets(data):
                    payload = payload_at(data, at)
                    doc_id, ids = read_payload(payload)
                    out.append((number, at, len(payload), doc_id, len(ids), start, zlib.crc32(ids.astype("<u4", copy=False))))
                    start += len(ids)
                columns = zip(*out) if out else [[]] * len(_ENTRY)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_ENTRY)

    entries = storage.written(_files(spark, path).mapInArrow(run, ", ".join(f"{c} long" for c in _ENTRY)), "entries")
    totals = entries.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    bases = prefix_sums(totals, [], "file", "n", "base")
    entries.join(bases.select("file", "base"), "file").select(
        "file", "offset", "length", "doc_id", "n_tokens", (F.col("base") + F.col("start_in_file")).alias("start"), "ids_crc32"
    ).write.parquet(f"{path}/index")


_ENTRY = ["file", "offset", "length", "doc_id", "n_tokens", "start_in_file", "ids_crc32"]


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per record ``file``, ``offset``, ``length``, ``doc_id``, ``n_tokens``, ``start`` (tokens of all records before), ``ids_crc32``.

    The last is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers, taken
    from the file.
    """
    return spark.read.parquet(f"{path}/index")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``offset``, ``doc_id``, ``ids`` (little-endian unsigned 32-bit) of every record, checked."""

    def run(batches):
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer().to_pybytes()
                yield _rows(number, data, list(offsets(data)))

    return _files(spark, path).mapInArrow(run, _ROWS)


_ROWS = "file long, offset long, doc_id long, ids binary"


def _rows(number: int, data: bytes, places: list[int]) -> pa.RecordBatch:
    found = [read_payload(payload_at(data, at)) for at in places]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number] * len(places), pa.int64()), pa.array(places, pa.int64()),
            pa.array([doc_id for doc_id, _ in found], pa.int64()),
            pa.array([ids.astype("<u4").tobytes() for _, ids in found], pa.binary()),
        ],
        names=["file", "offset", "doc_id", "ids"],
    )


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """The records in an order that depends on ``seed`` alone: ``turn`` is the place, ascending within and across partitions.

    The index alone is shuffled and numbered; each file then hands out its records by offset.
    """
    entries = index(spark, path).select("file", "offset", F.xxhash64(F.lit(seed), "file", "offset").alias("turn"))
    return read(spark, path).join(entries, ["file", "offset"]).orderBy("turn", "file", "offset")
