"""Zipped CSV files as a data source: ``spark.read.format("zipped_csv").load(path)``.

Every member of every archive under the path is a partition. The task that reads it opens the archive in the store
it lies in, seeks the member by the archive's directory and inflates it as a stream, so neither the driver nor
any row ever holds an archive, and nothing is unpacked on disk. All columns are text, named by the first member's header.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "zipped_csv"
#: Lines of a batch, and bytes read at a time.
BATCH, BLOCK = 8192, 1 << 20


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (HDFS, object stores, local ones), and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


class Member:
    """An archive's member as a stream of bytes, inflated as it is read; close the archive with it."""

    def __init__(self, uri: str, name: str):
        store, path = store_of(uri)
        self.archive = zipfile.ZipFile(io.BufferedReader(_Seekable(store.open_input_file(path)), BLOCK))
        self.stream = self.archive.open(name)

    def __enter__(self):
        return self.stream

    def __exit__(self, *_):
        self.stream.close()
        self.archive.close()


class _Seekable(io.RawIOBase):
    """A file of a store as Python's own kind of file."""

    def __init__(self, file: pa.NativeFile):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        return self.file.seek(offset, whence)

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        got = self.file.read(len(buffer))
        buffer[: len(got)] = got
        return len(got)

    def close(self) -> None:
        if not self.closed:
            self.file.close()
        super().close()


def members(uri: str) -> list[tuple[str, str]]:
    """(archive, member) of the archive, or of all archives in the folder, by name; only their directories are read."""
    store, path = store_of(uri)
    info = store.get_file_info(path)
    if info.type == fs.FileType.Directory:
        inside = sorted(f.base_name for f in store.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File and f.extension == "zip" and not f.base_name.startswith("."))
        archives = [f"{uri.rstrip('/')}/{name}" for name in inside]
    elif info.type == fs.FileType.File:
        archives = [uri]
    else:
        raise FileNotFoundError(uri)
    out = []
    for archive in archives:
        store, path = store_of(archive)
        with zipfile.ZipFile(io.BufferedReader(_Seekable(store.open_input_file(path)), BLOCK)) as z:
            out += [(archive, m.filename) for m in z.infolist() if not m.is_dir()]
    return out


class _Part(InputPartition):
    def __init__(self, archive: str, member: str):
        self.archive, self.member = archive, member


class ZippedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, uri: str, first_only: bool, lines: bool):
        self.schema, self.uri, self.first_only, self.lines = schema, uri, first_only, lines

    def partitions(self) -> list[InputPartition]:
        found = members(self.uri)
        if self.first_only:
            seen: set[str] = set()
            found = [m for m in found if not (m[0] in seen or seen.add(m[0]))]
        return [_Part(*m) for m in found]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        names = self.schema.names
        with Member(partition.archive, partition.member) as stream:
            text = io.TextIOWrapper(stream, "utf-8-sig", newline="")
            if self.lines:
                while some := text.readlines(BLOCK):
                    yield pa.RecordBatch.from_arrays([pa.array([x.rstrip("\r\n") for x in some], pa.string())], names=names)
                return
            rows = csv.reader(text)
            header = [h.strip() for h in next(rows, [])]
            place = [header.index(n) if n in header else None for n in names]
            batch: list[list[str]] = []
            for row in rows:
                if row:
                    batch.append(row)
                if len(batch) == BATCH:
                    yield self._batch(batch, place)
                    batch = []
            if batch:
                yield self._batch(batch, place)

    def _batch(self, rows: list[list[str]], place: list[int | None]) -> pa.RecordBatch:
        """Columns by name; empty fields and those that a line lacks are null."""
        columns = [[(r[i] or None) if i is not None and i < len(r) else None for r in rows] for i in place]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=self.schema.names)


class ZippedCsv(DataSource):
    """Options: path; members = all (first: each archive's first member only); lines = true gives raw lines in the column value."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _lines(self) -> bool:
        return self.options.get("lines", "false").lower() == "true"

    def schema(self) -> T.StructType:
        if self._lines():
            return T.StructType([T.StructField("value", T.StringType())])
        found = members(self.options["path"])
        if not found:
            raise ValueError(f"no archive member in {self.options['path']}")
        with Member(*found[0]) as stream:
            header = next(csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline="")), [])
        return T.StructType([T.StructField(h.strip(), T.StringType()) for h in header])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZippedReader(schema, self.options["path"], self.options.get("members", "all") == "first", self._lines())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the store that Spark would look in."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(made).toString()


def read(spark: SparkSession, path: str, members: str = "all", lines: bool = False) -> DataFrame:
    """The archives at ``path`` (one, or a folder of them): text columns by header, or raw ``lines`` (column value)."""
    from ..shipping import ship

    ship(spark)
    spark.dataSource.register(ZippedCsv)
    return spark.read.format(NAME).option("members", members).option("lines", str(lines).lower()).load(qualified(spark, path))


def write(rows: DataFrame, folder: str, header: bool = True) -> DataFrame:
    """A row (archive, n) for each archive written into ``folder``: every partition of ``rows`` becomes a zipped CSV file, streamed by its task.

    An archive is written under another name and renamed when it is whole, so a task that is run again replaces it.
    """
    from pyspark import TaskContext

    from ..shipping import ship

    ship(rows.sparkSession)
    target, names = qualified(rows.sparkSession, folder).rstrip("/"), rows.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, count = TaskContext.get().partitionId(), 0
        attempt = TaskContext.get().taskAttemptId()
        store, at = store_of(target)
        store.create_dir(at)
        name = f"part-{number:05d}"
        with store.open_output_stream(f"{at}/.{name}-{attempt}") as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(f"{name}.csv", "w", force_zip64=True) as member:
                text = io.TextIOWrapper(member, "utf-8", newline="", write_through=True)
                made = csv.writer(text)
                if header:
                    made.writerow(names)
                for batch in batches:
                    made.writerows(zip(*[c.to_pylist() for c in batch.columns], strict=True))
                    count += batch.num_rows
                text.flush()
        store.move(f"{at}/.{name}-{attempt}", f"{at}/{name}.zip")
        yield pa.RecordBatch.from_arrays([pa.array([f"{name}.zip"]), pa.array([count], pa.int64())], names=["archive", "n"])

    return rows.mapInArrow(pack, "archive string, n long")
