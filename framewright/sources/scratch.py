"""What driver and executors share: folders, file systems, this library's code."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def new_folder(spark: SparkSession) -> str:
    """A new folder URI under the folder that driver and executors share.

    `spark.checkpoint.dir` names it; only where that is unset and all is on one machine (tests)
    a temporary folder is made and remembered in the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("framewright.scratch", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="framewright-")
        spark.conf.set("framewright.scratch", base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + os.path.abspath(base)
    return f"{base.rstrip('/')}/framewright-{uuid.uuid4().hex}"


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI; usable in the driver and in tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def ship(spark: SparkSession) -> None:
    """Give Python workers this package where their path doesn't have it (once per application)."""
    root = Path(__file__).resolve().parents[2]
    if str(root) in os.environ.get("PYTHONPATH", "").split(":"):
        return
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    target = Path(os.path.realpath(tempfile.mkdtemp(prefix="framewright-code-"))) / "framewright.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "framewright").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(spark.sparkContext.applicationId)
