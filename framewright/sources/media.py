"""Media files as a data source: names, sizes and leading bytes.

`spark.read.format("media_headers")` lists a tree in parallel and reads the first bytes of its files by range, however long they are.
Conditions on `subset`, `chunk`, `input_camera` and `episode` (equal, or in a list) are pushed into the listing: directories that can't
hold such files aren't opened.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from framewright.sources.scratch import filesystem, ship

SCHEMA = "path string, subset string, chunk string, input_camera string, episode string, bytes long, header binary"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
PARTS = ("subset", "chunk", "input_camera", "episode")
MEDIUM = re.compile(r"(.*)/videos/(chunk-[0-9]+)/([^/]+)/(episode_[0-9]+)\.mp4")
BATCH = 1000  # files


class Piece(InputPartition):
    """Directories whose trees a task lists, and files that the driver met above them: (path, bytes), below the root. Of the trees' files a task takes one slice."""

    def __init__(self, folders: list[str], files: list[tuple[str, int]], part: int = 0):
        self.folders, self.files, self.part = folders, files, part


class MediaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.ending = options["path"], options.get("ending", ".mp4")
        self.header, self.splits, self.slices = (int(options.get(k, default)) for k, default in (("bytes", "12"), ("splits", "8"), ("slices", "1")))
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or len(f.attribute) != 1 or f.attribute[0] not in PARTS:
                yield f
            else:
                name = f.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values

    def may_hold(self, folder: str) -> bool:
        """Whether files below a directory (its path below the root) can be wanted."""
        parts = folder.split("/")
        if "videos" not in parts:
            subsets = self.wanted.get("subset")
            return subsets is None or any(s == folder or s.startswith(f"{folder}/") or folder.startswith(f"{s}/") for s in subsets)
        at = len(parts) - 1 - parts[::-1].index("videos")
        known = {"subset": "/".join(parts[:at]), **dict(zip(PARTS[1:3], parts[at + 1:at + 3]))}
        return all(known[name] in values for name, values in self.wanted.items() if name in known)

    def listed(self, system, base: str, folder: str) -> tuple[list[str], list[tuple[str, int]]]:
        """Directories and files (path, bytes) right below one; hidden ones are passed over."""
        from pyarrow import fs

        folders, files = [], []
        for info in system.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/"), recursive=False)):
            name = f"{folder}/{info.base_name}".lstrip("/")
            if info.base_name[:1] in (".", "_"):
                continue
            if info.type == fs.FileType.Directory:
                if self.may_hold(name):
                    folders.append(name)
            elif name.endswith(self.ending) and (not self.wanted or self.row(name)):
                files.append((name, info.size))
        return folders, files

    def row(self, path: str) -> tuple | None:
        """Subset, chunk, camera and episode of a path (nulls where it has none); None where a condition excludes it."""
        m = MEDIUM.fullmatch(path)
        found = m.groups() if m else (None,) * 4
        return found if all(found[PARTS.index(name)] in values for name, values in self.wanted.items()) else None

    def partitions(self) -> list[InputPartition]:
        """The driver lists from the top until there are as many directories as splits."""
        system, base = filesystem(self.root)
        folders, files = [""], []
        while folders and len(folders) < self.splits:
            below = [self.listed(system, base, f) for f in folders]
            folders = [f for found, _ in below for f in found]
            files += [f for _, found in below for f in found]
        folders.sort()
        files.sort()
        pieces = [Piece(folders[i::self.splits], files[i::self.splits] if part == 0 else [], part) for i in range(self.splits) for part in range(self.slices)]
        return [p for p in pieces if p.folders or p.files] or [Piece([], [])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(self.root)
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            types = [pa.string()] * 5 + [pa.int64(), pa.binary()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], COLUMNS)
            held.clear()
            return out

        def take(files: list[tuple[str, int]]) -> None:
            for path, size in files:
                found = self.row(path)
                if found:
                    header = None
                    if self.header:
                        with system.open_input_file(f"{base}/{path}") as source:
                            header = source.read_at(size if self.header < 0 else min(self.header, size), 0)
                    held.append((path, *found, size, header))

        take(partition.files)
        folders = list(partition.folders)
        while folders:
            more, files = self.listed(system, base, folders.pop())
            folders += more
            files = [f for f in files if zlib.crc32(f[0].encode()) % self.slices == partition.part]
            for first in range(0, len(files), BATCH):
                take(files[first:first + BATCH])
                if len(held) >= BATCH:
                    yield batch()
        if held:
            yield batch()


class MediaHeaders(DataSource):
    """Options: path, ending of the names, bytes to read of each file (0: none is opened, -1: all), splits, and slices: into how many tasks' shares the
    files of one directory are cut (each lists it; for trees whose directories hold very many files)."""

    @classmethod
    def name(cls) -> str:
        return "media_headers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MediaReader:
        return MediaReader(self.options)


def scan_headers(spark: SparkSession, root: str, ending: str = ".mp4", header: int = 12, slices: int = 1) -> DataFrame:
    """`SCHEMA` of the files below `root`, paths relative to it. subset to episode: of videos at their place in a dataset, else null."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MediaHeaders)
    splits = 2 * spark.sparkContext.defaultParallelism
    return spark.read.format("media_headers").option("ending", ending).option("bytes", header).option("splits", splits).option("slices", slices).load(root)
