"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. The reader deals byte ranges, not
files, to tasks: a task looks for gzip magic in its range, takes the first
candidate whose header decodes to a WARC version line and which the next record or
the end of the file follows, and owns the records
that start inside the range, the last of which it reads beyond the end. From a
valid record on it goes from member to member.

A record has the fields that WARC 1.1 asks for (type, id, date, length, and for these types target, payload digest and content type) and a field
of its own with the page's id; its block is an HTTP response, of a revisit only the head, which names the payload's length.

Defined cases: a null payload counts as empty; a null id is a field that is left out, and gives the record an id by chance; a null or
empty url becomes `urn:page:` and the page's id; repeated rows are one record each (of the same record id); empty tables give no file.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import common

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
READ_BYTES = 1 << 17
WRITTEN = "file string, bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def mark_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads of `least_bytes` or more the largest page_id is kept whole, the others refer to it.

    The groups of equal payloads (a row each) are written first, so that Spark knows their size: few are broadcast and no payload is
    shuffled; many are met by a join whose large side may be split. A payload held by a third of the pages is one row there.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    with_digest = pages.select("page_id", url.alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = (
        with_digest.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies"))
        .filter("copies > 1").select("digest", "original")
    )
    return with_digest.join(common.checkpoint(groups), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(F.col("page_id") != F.col("original"), F.col("original")).alias("refers_to")
    )


def record_id(page_id: int | None, digest: str) -> str:
    """Follows from page and payload, so that a revisit knows the response's; by chance without a page."""
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def target_of(url: str | None, page_id: int | None) -> str:
    """The url, with what can't stand in a header percent-encoded."""
    return urllib.parse.quote(url, safe=";/?:@&=+$,-_.!~*'()#[]%|") if url else f"urn:page:{'' if page_id is None else page_id}"


def record(page_id: int | None, payload: bytes, digest: str, refers_to: int | None, url: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record: a response, or a revisit of an equal payload, which has the HTTP head only."""
    kind, body = ("response", payload) if refers_to is None else ("revisit", b"")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + body
    revisit = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Page-Refers-To: {refers_to}"]
    head = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target_of(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", *([] if refers_to is None else revisit),
        *([] if page_id is None else [f"Page-ID: {page_id}"]), "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _writer(folder: str, level: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, out, size = TaskContext.get(), None, 0
        name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        fs, path = common.filesystem(folder)
        try:
            for batch in batches:
                for key, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        fs.create_dir(path, recursive=True)
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip_member(record(key, payload, digest, refers_to, url, date), level)
                    out.write(member)
                    size += len(member)
        finally:
            if out is not None:
                out.close()
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64())], ["file", "bytes"])

    return write


def write_archives(marked: DataFrame, folder: str, level: int = 3, date: datetime.datetime | None = None) -> None:
    """Archives of (page_id, url, payload, digest, refers_to), and a manifest of the files that Spark committed; date: now, or that of the crawl."""
    common.ship(marked.sparkSession)
    stamp = (date or datetime.datetime.now(datetime.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    marked.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(_writer(f"{folder}/data", level, stamp), WRITTEN).write.parquet(f"{folder}/manifest")


class MemberStream:
    """Gzip members of a file from a position on, read ahead in bounded pieces."""

    def __init__(self, source, start: int, size: int):
        self.source, self.at, self.size, self.held = source, start, size, b""

    def more(self) -> bool:
        """Extends what is held; False at the end of the file."""
        end = self.at + len(self.held)
        if end >= self.size:
            return False
        self.source.seek(end)
        self.held += self.source.read(min(READ_BYTES, self.size - end))
        return True

    def skip(self, n: int) -> None:
        self.held, self.at = self.held[n:], self.at + n

    def is_record(self) -> bool:
        """Whether a gzip member begins here that holds a WARC record."""
        while True:
            try:
                head = zlib.decompressobj(31).decompress(self.held, len(VERSION))
            except zlib.error:
                return False
            if len(head) == len(VERSION):
                return head == VERSION
            if not self.more():
                return False

    def is_followed(self) -> bool:
        """Whether the member decodes and a record or the end of the file comes next: a member inside another's stored bytes isn't one."""
        probe = MemberStream(self.source, self.at, self.size)
        try:
            probe.member()
        except (zlib.error, ValueError):
            return False
        return probe.at >= self.size or probe.is_record()

    def seek_record(self, end: int) -> bool:
        """Goes to the next record that starts before `end`."""
        while self.at < end:
            found = self.held.find(MAGIC)
            if found >= 0:
                self.skip(found)
                if self.at < end and self.is_record() and self.is_followed():
                    return True
                self.skip(1)
            else:
                self.skip(max(0, len(self.held) - len(MAGIC) + 1))
                if not self.more():
                    return False
        return False

    def member(self) -> bytes:
        """Decodes the member that begins here and goes behind it."""
        z, parts = zlib.decompressobj(31), []
        while True:
            parts.append(z.decompress(self.held))
            if z.eof:
                self.at, self.held = self.at + len(self.held) - len(z.unused_data), z.unused_data
                return b"".join(parts)
            self.skip(len(self.held))
            if not self.more():
                raise ValueError("truncated gzip member")


def parse(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record; a response's payload is measured and its digest verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    if len(rest) != size + 4:
        raise ValueError("damaged WARC record")
    number = lambda name: int(fields[name]) if name in fields else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http)[1])
    if fields["WARC-Type"] == "response":
        if length != len(payload) or digest != hashlib.sha1(payload).hexdigest():
            raise ValueError("damaged WARC record")
        return number("Page-ID"), length, digest, "response", None
    return number("Page-ID"), length, digest, "revisit", number("Page-Refers-To")


def records_in(source, start: int, end: int, size: int) -> Iterator[tuple]:
    """The records of a file that start in [start, end)."""
    stream = MemberStream(source, start, size)
    while stream.at < end and stream.seek_record(end):
        while stream.at < end and (stream.held or stream.more()):
            if not stream.is_record():
                break
            yield parse(stream.member())


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = common.filesystem(folder)
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        for batch in batches:
            for split in batch.to_pylist():
                rows = []
                with fs.open_input_file(f"{path}/{split['file']}") as source:
                    for row in records_in(source, split["start"], min(split["start"] + split["length"], split["bytes"]), split["bytes"]):
                        rows.append(row)
                        if len(rows) == 5000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return read


def read_archives(spark, folder: str, split_bytes: int = 4 << 20) -> DataFrame:
    """A row per record of all archives; a task reads byte ranges of `split_bytes`."""
    common.ship(spark)
    files = spark.read.schema(WRITTEN).parquet(f"{folder}/manifest")
    splits = files.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"), F.lit(split_bytes).alias("length"))
    dealt = splits.repartition(common.shuffle_partitions(spark), "file", "start")
    return dealt.mapInArrow(_reader(f"{folder}/data"), RECORDS)
