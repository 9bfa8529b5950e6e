"""Folders as a Spark data source, and files read in chunks on executors.

The driver walks folders down to a depth and makes one partition of each; the files in them are listed by tasks, which
go on into deeper folders one at a time.  So neither the driver nor a task ever holds the names of all files, and empty files
are rows like others.  Files are opened through the file system of their URI.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, file_name string, length long, modified timestamp"
#: Levels of folders that become partitions.
DEPTH = 2
ROWS = 4096
#: Bytes of a file that are read at once.
CHUNK = 1 << 20
#: Files of more bytes than this have no content column, and images of more are judged by their first bytes.
CONTENT_BYTES = 1 << 28


def _files(uri: str):
    """The file system and path of a URI or a plain path. Names stand in it as they are, without escapes, as Spark writes them."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        path = rest if scheme == "file" and colon else uri
        return fs.LocalFileSystem(), os.path.abspath("/" + path.lstrip("/") if scheme == "file" and colon else path)
    authority, slash, path = rest.removeprefix("//").partition("/")
    return fs.FileSystem.from_uri(f"{scheme}://{authority}{slash}{quote(path)}")


def _root(uri: str) -> str:
    """What stands before a path in the names of files: as Spark writes them."""
    split = urlsplit(uri)
    return "file:" if split.scheme in ("", "file") else f"{split.scheme}://{split.netloc}"


class Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.path, self.deep = path, deep


class FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.depth = options["path"], int(options.get("depth", DEPTH))

    def _children(self, path: str) -> tuple[list, list[str]]:
        """Files and folders right below a folder; a folder that is gone has none."""
        from pyarrow import fs

        found = _files(self.uri)[0].get_file_info(fs.FileSelector(path, allow_not_found=True))
        return [f for f in found if f.type == fs.FileType.File], sorted(f.path for f in found if f.type == fs.FileType.Directory)

    def partitions(self) -> list[Folder]:
        level, out = [_files(self.uri)[1]], []
        for _ in range(self.depth):
            out += [Folder(p, False) for p in level]
            level = [c for p in level for c in self._children(p)[1]]
        return [*out, *(Folder(p, True) for p in level)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        root, todo = _root(self.uri), [partition.path]
        while todo:
            files, folders = self._children(todo.pop())
            if partition.deep:
                todo += reversed(folders)
            for k in range(0, len(files), ROWS):
                some = files[k : k + ROWS]
                yield pa.record_batch(
                    {
                        "path": pa.array([root + f.path for f in some], pa.string()),
                        "file_name": pa.array([f.base_name for f in some], pa.string()),
                        "length": pa.array([f.size for f in some], pa.int64()),
                        "modified": pa.array([f.mtime_ns and f.mtime_ns // 1000 for f in some], pa.timestamp("us", "UTC")),
                    }
                )


class Folders(DataSource):
    """spark.read.format("folders").option("depth", 2).load(path)"""

    @classmethod
    def name(cls) -> str:
        return "folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options)


def listing(spark: SparkSession, folder: str, depth: int = DEPTH) -> DataFrame:
    """path, file_name, length and modified of every file below a folder, at any depth, empty ones too."""
    spark.dataSource.register(Folders)
    return spark.read.format("folders").option("depth", depth).load(folder)


def _mapped(files: DataFrame, schema: str, row) -> DataFrame:
    """The columns of files with those that ``row`` makes of a path and a length, file by file."""
    columns, fields = files.columns, [f.strip().split(" ") for f in schema.split(",")]
    kinds = {n: {"string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[t] for n, t in fields}

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            # One file at a time: contents may be large.
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                made = row(one.column("path")[0].as_py(), one.column("length")[0].as_py())
                arrays = {c: one.column(c) for c in columns}
                yield pa.record_batch(arrays | {n: pa.array([v], kinds[n]) for n, v in made.items()})

    kept = ", ".join(f"`{n}` {t}" for n, t in files.dtypes)
    return files.mapInArrow(run, f"{kept}, {schema}")


def contents(files: DataFrame) -> DataFrame:
    """Adds content, read by executors; null for files that are too large for a row or cannot be read."""

    def row(path: str, length: int) -> dict:
        if length is not None and length > CONTENT_BYTES:
            return {"content": None}
        try:
            fs, at = _files(path)
            with fs.open_input_stream(at) as f:
                return {"content": f.read()}
        except OSError:
            return {"content": None}

    return _mapped(files, "content binary", row)


def digests(files: DataFrame, check=None) -> DataFrame:
    """Adds file_hash (SHA-256; null for empty files and for those that cannot be read), head (the first 8 bytes) and whole.

    A file is read once, ``CHUNK`` bytes at a time.  ``check(content, extension)`` says whether a file that is not too large is whole;
    whole is null for others.
    """

    def row(path: str, length: int) -> dict:
        digest, head, kept = hashlib.sha256(), b"", []
        extension = os.path.splitext(path)[1].lower()
        keep = check is not None and length <= CONTENT_BYTES and check(None, extension) is not None
        try:
            fs, at = _files(path)
            with fs.open_input_file(at) as f:
                while chunk := f.read(CHUNK):
                    digest.update(chunk)
                    if len(head) < 8:
                        head += chunk[: 8 - len(head)]
                    if keep:
                        kept.append(chunk)
        except OSError:
            return {"file_hash": None, "head": None, "whole": None}
        return {"file_hash": digest.hexdigest() if head else None, "head": head, "whole": check(b"".join(kept), extension) if keep and head else None}

    return _mapped(files, "file_hash string, head binary, whole boolean", row)
