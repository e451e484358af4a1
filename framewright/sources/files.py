"""Reading and writing the files of a dataset."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.sources.scratch import filesystem, ship
from framewright.sources.versions import Version, VersionedTable

EPISODE = "episode_index long, length long"
PADDING = "source struct<episode_index: long, frame_count: long, tail_missing_count: long, missing_frame_indices: array<long>>"


def scan_frames(spark: SparkSession, root: str) -> DataFrame:
    """All episodes' frames below `root`; the chunk comes from the directory."""
    return spark.read.option("recursiveFileLookup", True).parquet(root).withColumn("chunk", F.regexp_extract("_metadata.file_path", "chunk(?:=|%3D)([^/]+)/", 1))


def scan_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def scan_padding_sidecars(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Padding sidecars of several roots; the camera is the parent directory."""
    rows = spark.read.schema(PADDING).option("recursiveFileLookup", True).json(roots)
    return rows.select("source.*", F.regexp_extract("_metadata.file_path", "camera(?:=|%3D)([^/]+)/", 1).alias("camera"))


def write_media(rows: DataFrame, root: str) -> int:
    """Files of (path, content) below `root`, each under its final name once it is whole; returns how many."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, base = filesystem(root)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder, _, name = f"{base}/{path}".rpartition("/")
                system.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}.part"
                with system.open_output_stream(part, compression=None) as out:
                    out.write(content or b"")
                system.move(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["path"])

    ship(rows.sparkSession)
    return rows.select("path", F.col("content").cast("binary")).mapInArrow(write, "path string").count()


def media_catalog(media: DataFrame) -> DataFrame:
    """The videos among `media_headers` rows, by subset, chunk, camera and episode; others fall out."""
    return media.filter("episode is not null").select("path", "subset", "chunk", "input_camera", "episode", "bytes")


def has_mp4_signature(content) -> "F.Column":
    return (F.octet_length(content) >= 12) & (F.substring(content, 5, 4) == F.lit(bytearray(b"ftyp")))


def write_frames(frames: DataFrame, root: str, codec: str = "zstd") -> None:
    """Frames into chunk directories of a new root."""
    frames.write.option("compression", codec).partitionBy("chunk").parquet(root)


def codec_of(spark: SparkSession, root: str) -> str:
    """Compression of the frames below `root`, by the footer of one file."""
    name = spark.read.option("recursiveFileLookup", True).parquet(root).limit(1).select("_metadata.file_path").first()
    return "zstd" if name is None else _codec(name[0])


def _codec(name: str) -> str:
    from pyarrow import parquet

    system, path = filesystem(name)
    with system.open_input_file(path) as source:
        return parquet.ParquetFile(source).metadata.row_group(0).column(0).compression.lower()


def rewrite_frames(table: VersionedTable, frames: DataFrame, changed_chunks: DataFrame) -> Version:
    """A version of `table` (whose folders are chunks) in which `frames` stand for the chunks that have changes (column chunk).

    Folders of other chunks are taken over, and the compression is that of the version before; that version stays as it is. A
    chunk that other writers changed meanwhile is an error (`Superseded`).
    """
    base = table.current()
    codec = codec_of(table.spark, f"{table.root}/{base.folders[0][1]}") if base.folders else "zstd"
    chunks = changed_chunks.select("chunk").distinct()
    keys = [r["chunk"] for r in chunks.collect()]  # as many as chunk folders
    return table.replace(base, frames.join(chunks, "chunk", "left_semi"), "chunk", keys, codec)


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Compact JSON lines; null keys are kept."""
    rows.write.option("ignoreNullFields", False).json(path)


def append_events(events: DataFrame, path: str, *by: str) -> None:
    """Adds events to a log, in folders by some columns where they are given."""
    events.write.mode("append").partitionBy(*by).json(path)
