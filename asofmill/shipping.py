"""What driver and executors share: this package, for sessions that were started without ``--py-files``, and a folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for an application; Spark's own file server hands the archive out. A package that came as an archive is there already."""
    context, root = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    _shipped.add(context.applicationId)
    path = os.path.join(tempfile.mkdtemp(prefix="asofmill-"), "asofmill.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); one of our own only where that is unset, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="asofmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")
