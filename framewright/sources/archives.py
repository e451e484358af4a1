"""TAR archives as a data source to write to.

`rows.write.format("tar_archives")` takes rows (archive, member, payload), an archive's rows in one partition and in order, and streams
them: a task holds one payload. Archives get their names when the whole job commits (the driver gets the names, two for each archive, and renames); a task that fails, or a job that
is given up, leaves none.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from framewright.sources.media import scan_headers
from framewright.sources.scratch import filesystem, new_folder, ship


RENAMES = 32  # at once, when the job commits
MEMBERS, BYTES = 1000, 64 << 20  # about as much a task takes


@dataclass
class Written(WriterCommitMessage):
    archives: list[tuple[str, str]]  # (part, name), below the folder


class TarWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, base = filesystem(self.folder)
        attempt = TaskContext.get().taskAttemptId()
        made: list[tuple[str, str]] = []
        out = tar = None
        try:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(c)) for c in ("archive", "member", "payload")]
                for archive, member, payload in zip(*columns):
                    archive = archive.as_py()
                    if not made or made[-1][1] != archive:
                        if tar is not None:
                            tar.close()
                            out.close()
                        if any(name == archive for _, name in made):
                            raise ValueError(f"rows of {archive} aren't in order")
                        folder, _, name = archive.rpartition("/")
                        system.create_dir(f"{base}/{folder}", recursive=True)
                        made.append((f"{folder}/.{name}.{attempt}.part".lstrip("/"), archive))
                        out = system.open_output_stream(f"{base}/{made[-1][0]}", compression=None)
                        tar = tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT)
                    content = payload.as_buffer() if payload.is_valid else b""
                    info = tarfile.TarInfo(member.as_py())
                    info.size = len(content)
                    tar.addfile(info, io.BytesIO(content))
            if tar is not None:
                tar.close()
                out.close()
        except BaseException:
            if out is not None:
                out.close()
            self._remove(system, base, made)
            raise
        return Written(made)

    @staticmethod
    def _remove(system, base: str, made: list[tuple[str, str]]) -> None:
        for part, _ in made:
            if system.get_file_info(f"{base}/{part}").is_file:
                system.delete_file(f"{base}/{part}")

    def commit(self, messages: list[Written | None]) -> None:
        system, base = filesystem(self.folder)
        archives = [a for m in messages if m is not None for a in m.archives]
        if len({name for _, name in archives}) < len(archives):
            self.abort(messages)
            raise ValueError("an archive's rows lie in several partitions")
        with ThreadPoolExecutor(RENAMES) as pool:
            for _ in pool.map(lambda a: system.move(f"{base}/{a[0]}", f"{base}/{a[1]}"), archives):
                pass

    def abort(self, messages: list[Written | None]) -> None:
        system, base = filesystem(self.folder)
        for m in messages:
            if m is not None:
                self._remove(system, base, m.archives)


class TarArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tar_archives"

    def schema(self) -> str:
        return "archive string, member string, payload binary"

    def writer(self, schema, overwrite: bool) -> TarWriter:
        return TarWriter(self.options)


def dealt(rows: DataFrame, members: int, payload_bytes: int) -> DataFrame:
    """Archives dealt over as many tasks as `members` rows of `payload_bytes` in all need, each in one and in order."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-members // MEMBERS), -(-payload_bytes // BYTES))
    return rows.repartition(tasks, "archive").sortWithinPartitions("archive", "member")


def pack_export(members: DataFrame, shard: list[str], folder: str, overwrite: bool = False) -> DataFrame:
    """One TAR per shard, members in name order; a report row (status, archive, members, payload_bytes) per shard.

    members: the shard's columns, archive (its path below `folder`), member, payload. An archive that is there is skipped unless `overwrite` is set.
    A shard is written by one task, sorted by Spark (which spills) and streamed; tasks are as many as the members and their bytes ask for.
    """
    from pyarrow import fs

    spark = members.sparkSession
    ship(spark)
    spark.dataSource.register(TarArchives)
    system, base = filesystem(folder)
    there = system.get_file_info(base).type == fs.FileType.Directory
    known = scan_headers(spark, folder, ".tar", 0).select(F.col("path").alias("archive")) if there else spark.createDataFrame([], "archive string")
    # what was there before this run: written down, as the folder is about to change
    kept = new_folder(spark)
    known.write.parquet(kept)
    known = spark.read.schema("archive string").parquet(kept).withColumn("there", F.lit(True))
    report = members.groupBy(*shard, "archive").agg(F.count("*").alias("members"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("payload_bytes"))
    counted = new_folder(spark)
    report.write.parquet(counted)
    report = spark.read.schema(report.schema).parquet(counted)
    rows, due = members.select("archive", "member", F.col("payload").cast("binary").alias("payload")), report
    if not overwrite:
        rows, due = (r.join(known, "archive", "left_anti") for r in (rows, due))
    size = due.agg(F.coalesce(F.sum("members"), F.lit(0)).alias("members"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("payload_bytes")).first()
    dealt(rows, **size.asDict()).write.format("tar_archives").mode("append").save(folder)
    status = F.when(F.col("there") & (not overwrite), "skipped").otherwise("created")
    return report.join(known, "archive", "left").select(*shard, status.alias("status"), "archive", "members", "payload_bytes")
