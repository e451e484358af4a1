"""Tables in versions: data folders that never change, and a manifest that names those of each version.

A version is a file that is created only if it is absent, so of two writers that start from one version exactly one
gets the next: check and write are one step. A version may name folders of the versions before it (copy on write), and every version stays
readable, whatever becomes of a job that prepares the next one. A manifest has a line for each folder, not for each file.

The file that makes a version is put in its place by a hard link on a local file system, elsewhere by a rename that refuses to
overwrite (as HDFS has it); object stores without either aren't fit for it.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from framewright.sources.scratch import filesystem


class Superseded(Exception):
    """Another writer has made the next version."""


def create_absent(spark: SparkSession, uri: str, content: bytes) -> bool:
    """Creates a file, whole, unless there is one of that name; whether it did."""
    part = f"{uri}.{uuid.uuid4().hex}.part"
    system, path = filesystem(part)
    with system.open_output_stream(path, compression=None) as out:
        out.write(content)
    final = filesystem(uri)[1]
    if uri.startswith("file:") or "://" not in uri:
        try:
            os.link(path, final)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(path)
    jvm = spark.sparkContext._jvm
    new = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new(uri).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(new(part), new(uri), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception as e:
        context.delete(new(part), False)
        if "FileAlreadyExists" in str(e):
            return False
        raise


@dataclass(frozen=True)
class Version:
    number: int = 0
    schema: StructType = field(default_factory=StructType)
    folders: tuple[tuple[str, str], ...] = ()  # (key, folder below the root); one key may have several
    properties: dict = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> Version:
        from pyarrow import fs

        system, path = filesystem(f"{self.root}/_versions")
        found = [f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.base_name.endswith(".json")]
        return self.version(int(max(found).partition(".")[0])) if found else Version()

    def version(self, number: int) -> Version:
        system, path = filesystem(f"{self.root}/_versions/{number:010d}.json")
        with system.open_input_stream(path, compression=None) as source:
            held = json.loads(source.read())
        return Version(number, StructType.fromJson(held["schema"]), tuple(map(tuple, held["folders"])), held["properties"])

    def read(self, version: Version | None = None, keys: Iterable[str] | None = None) -> DataFrame:
        """Rows of a version (the current one), of some keys only where they are given."""
        version = version or self.current()
        wanted = None if keys is None else set(keys)
        folders = [f"{self.root}/{folder}" for key, folder in version.folders if wanted is None or key in wanted]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def stage(self, rows: DataFrame, by: str | None = None, codec: str = "zstd") -> list[tuple[str, str]]:
        """Writes rows into new folders that no version names yet, one for each value of `by`: (key, folder)."""
        from pyarrow import fs

        folder = f"data/{uuid.uuid4().hex}"
        if by is None:
            rows.write.option("compression", codec).parquet(f"{self.root}/{folder}")
            return [("", folder)]
        keyed = rows.withColumn("part", F.col(by).cast("string")).hint("rebalance", "part")
        keyed.write.option("compression", codec).partitionBy("part").parquet(f"{self.root}/{folder}")
        system, path = filesystem(f"{self.root}/{folder}")
        names = sorted(f.base_name for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part="))
        return [(unquote(name.partition("=")[2]), f"{folder}/{name}") for name in names]

    def commit(self, base: Version, schema: StructType, folders: Iterable[tuple[str, str]], properties: dict | None = None) -> Version:
        """The version after `base`; `Superseded` if there is one already."""
        number = base.number + 1
        new = Version(number, schema, tuple(folders), base.properties | (properties or {}))
        content = json.dumps({"schema": schema.jsonValue(), "folders": new.folders, "properties": new.properties}).encode()
        system, path = filesystem(f"{self.root}/_versions")
        system.create_dir(path, recursive=True)
        if not create_absent(self.spark, f"{self.root}/_versions/{number:010d}.json", content):
            raise Superseded(f"version {number} of {self.root} is another writer's")
        return new

    def append(self, rows: DataFrame, by: str | None = None, codec: str = "zstd") -> Version:
        """A version with more rows; whoever comes between is waited out, since rows that are only added don't conflict."""
        staged = self.stage(rows, by, codec)
        while True:
            base = self.current()
            try:
                return self.commit(base, rows.schema, (*base.folders, *staged))
            except Superseded:
                continue

    def replace(self, base: Version, rows: DataFrame, by: str, keys: Iterable[str], codec: str = "zstd", properties: dict | None = None) -> Version:
        """A version in which `rows` stand for all that `base` has under `keys`; the folders of other keys are taken over."""
        gone = set(keys)
        staged = self.stage(rows, by, codec)
        return self.commit(base, rows.schema, [*(f for f in base.folders if f[0] not in gone), *staged], properties)


def retried(attempt: Callable[[], object]) -> object:
    """The result of an attempt that reads the current version anew each time, until no other writer comes between."""
    while True:
        try:
            return attempt()
        except Superseded:
            continue
