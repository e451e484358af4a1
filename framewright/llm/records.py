"""Token sequences as length-delimited binary records with a separate offset index.

Record: length (uint64), masked checksum of those 8 bytes (uint32), payload,
masked checksum of the payload (uint32), all little-endian. Payload: a byte of flags
(1: the id is null, 2: wide ids), the document's id (int64), its token ids (uint16,
or uint32 where an id needs it).
The mask rotates a CRC-32 right by 15 bits and adds a constant, so that a
checksum of data that itself holds checksums stays useful.
The index is a Parquet table (file, ordinal, offset, length, number of ids, ids before it in the file), so that records
can be read in any order, by byte range, and the place of a record among all ids is known without reading any.

Defined cases: a null or empty text gives a record with the end id only; null
doc_ids come first; repeated doc_ids keep one record each, in the order of their texts' hashes; an empty table gives
no files and an empty index; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm import common
from framewright.llm.tokens import token_ids

MASK_DELTA = 0xA282EAD8
HEAD, TAIL, KEY = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<Bq")
INDEX = "file string, ordinal long, offset long, length long, n_tokens long, tokens_before long"
RANGE_BYTES = 4 << 20  # of a file that a task reads at a time


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, TAIL.pack(masked_crc(size)), payload, TAIL.pack(masked_crc(payload))))


def unframe(record: bytes) -> bytes:
    """The payload of one framed record; ValueError if a length or checksum is wrong."""
    if len(record) < HEAD.size + TAIL.size:
        raise ValueError("truncated record")
    size, check = HEAD.unpack_from(record)
    payload = record[HEAD.size:-TAIL.size]
    if check != masked_crc(record[:8]) or size != len(payload):
        raise ValueError("wrong record length")
    if TAIL.unpack_from(record, len(record) - TAIL.size)[0] != masked_crc(payload):
        raise ValueError("wrong payload checksum")
    return payload


def payload_of(doc_id: int | None, ids: bytes) -> bytes:
    """ids: uint32 bytes."""
    numbers = np.frombuffer(ids, "<u4")
    wide = bool(len(numbers)) and int(numbers.max()) > 0xFFFF
    return KEY.pack((doc_id is None) + 2 * wide, doc_id or 0) + (ids if wide else numbers.astype("<u2").tobytes())


def split_payload(payload: bytes) -> tuple[int | None, bytes]:
    flags, doc_id = KEY.unpack_from(payload)
    ids = payload[KEY.size:]
    return (None if flags & 1 else doc_id), ids if flags & 2 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def _writer(folder: str, vocabulary: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, out, offset, ordinal, tokens = TaskContext.get(), None, 0, 0, 0
        # the attempt is part of the name: a retried or speculative task never meets another's file
        name = f"records-{context.partitionId():06d}-{context.taskAttemptId()}.bin"
        encode, end = token_ids(vocabulary), struct.pack("<I", end_id)
        fs, path = common.filesystem(folder)
        try:
            for batch in batches:
                rows = []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encode(text.as_py()) + end
                    record = frame(payload_of(key, ids))
                    if out is None:
                        fs.create_dir(path, recursive=True)
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(record)
                    rows.append((ordinal, offset, len(record), len(ids) // 4, tokens))
                    ordinal, offset, tokens = ordinal + 1, offset + len(record), tokens + len(ids) // 4
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), *(pa.array(c, pa.int64()) for c in zip(*rows))], [c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return write


def write_records(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0) -> str:
    """Encode `docs` (doc_id, text) and write record files in ascending doc_id order; returns the index's path.

    Files follow each other in name order as the doc_id ranges do. The index
    names only the files of the attempts that Spark committed.
    """
    spark = docs.sparkSession
    common.ship(spark)
    n = common.shuffle_partitions(spark)
    # rows that share an id may be split between files
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    index = f"{folder}/index"
    ordered.mapInArrow(_writer(f"{folder}/data", vocabulary, end_id), INDEX).write.parquet(index)
    return index


RECORDS = "file string, ordinal long, start long, doc_id long, n_tokens long, ids_crc32 long"


def _reader(folder: str, run_bytes: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = common.filesystem(folder)
        source, opened, held, at = None, None, b"", 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if opened != row["file"]:
                    if source is not None:
                        source.close()
                    source, opened, held, at = fs.open_input_file(f"{path}/{row['file']}"), row["file"], b"", 0
                begin = row["offset"] - at
                if begin < 0 or begin + row["length"] > len(held):  # neighbours are read together
                    at, begin = row["offset"], 0
                    source.seek(at)
                    held = source.read(max(run_bytes, row["length"]))
                key, ids = split_payload(unframe(held[begin:begin + row["length"]]))
                if len(ids) // 4 != row["n_tokens"]:
                    raise ValueError("index and record disagree")
                out.append((row["file"], row["ordinal"], row["start"], key, len(ids) // 4, zlib.crc32(ids)))
            if out:
                columns = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 5))], [c.split()[0] for c in RECORDS.split(", ")])
        if source is not None:
            source.close()

    return read


def indexed(spark, folder: str) -> DataFrame:
    """The index with start, the ids of all records before: sums of the files before (a row per file) and what the index has."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = files.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("file_start"))
    return index.join(starts, "file").withColumn("start", F.col("file_start") + F.col("tokens_before")).drop("file_start", "tokens_before")


def read_records(spark, folder: str, run_bytes: int = 1 << 20, seed: int | None = None) -> DataFrame:
    """Digest rows (file, ordinal, start, doc_id, n_tokens, ids_crc32) of all records, through the index; checksums are verified.

    Tasks get byte ranges of files in file order; with a seed, records in an order of its own, each read by itself.
    """
    common.ship(spark)
    index, n = indexed(spark, folder), common.shuffle_partitions(spark)
    if seed is None:
        dealt = index.repartition(n, "file", F.expr(f"offset DIV {RANGE_BYTES}")).sortWithinPartitions("file", "offset")
    else:
        place = F.xxhash64(F.lit(seed), F.col("file"), F.col("ordinal"))
        dealt, run_bytes = index.repartition(n, place).sortWithinPartitions(place), 0
    return dealt.mapInArrow(_reader(f"{folder}/data", run_bytes), RECORDS)


def with_starts(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): where each document's ids lie among all."""
    return records.select("doc_id", "start", "n_tokens", "ids_crc32")
