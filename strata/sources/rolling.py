"""A sink of gzipped lines that rolls its files by what it has really written.

Each task writes into a folder of its own attempt below a stage, which readers don't see. When all tasks are done the
driver moves the files of the attempts that count into place; if one fails for good, the stage goes and nothing else.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SUFFIX = ".ndjson.gz"
LINES, BYTES = 200_000, 64 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path inside of it, whose characters stand for themselves; a path without a scheme is on a file
    system that all machines mount.
    """
    scheme, sign, rest = path.partition(":")
    if not sign or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), f"/{rest.lstrip('/')}"
    authority, _, inside = rest.lstrip("/").partition("/")
    store, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}/")
    return store, f"{root.rstrip('/')}/{inside}"


class RollingFile:
    """One task's files: a new one begins where the last would have more lines or bytes (before compression) than it may."""

    def __init__(self, store: fs.FileSystem, folder: str, name: str, most_lines: int, most_bytes: int) -> None:
        self.store, self.folder, self.name, self.most_lines, self.most_bytes = store, folder, name, most_lines, most_bytes
        self.files: list[str] = []
        self.out = None

    def add(self, line: bytes) -> None:
        if self.out is not None and (self.lines == self.most_lines or self.bytes + len(line) > self.most_bytes):
            self.close()
        if self.out is None:
            file = f"{self.name}-{len(self.files):05d}{SUFFIX}"
            self.out, self.pack, self.lines, self.bytes = self.store.open_output_stream(f"{self.folder}/{file}", compression=None), zlib.compressobj(wbits=31), 0, 0
            self.files.append(file)
        self.out.write(self.pack.compress(line))
        self.lines, self.bytes = self.lines + 1, self.bytes + len(line)

    def close(self) -> None:
        if self.out is not None:
            self.out.write(self.pack.flush())
            self.out.close()
            self.out = None


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[str]


class RollingWriter(DataSourceArrowWriter):
    def __init__(self, path: str, most_lines: int, most_bytes: int) -> None:
        self.path, self.most_lines, self.most_bytes, self.run = path.rstrip("/"), most_lines, most_bytes, uuid.uuid4().hex
        self.stage = f"{self.path}/_stage-{self.run}"

    def write(self, iterator) -> Written:
        task = TaskContext.get()
        store, folder = file_system(f"{self.stage}/{task.taskAttemptId()}")
        store.create_dir(folder, recursive=True)
        rolling = RollingFile(store, folder, f"part-{self.run[:12]}-{task.partitionId():05d}", self.most_lines, self.most_bytes)
        for batch in iterator:
            for line in batch.column(0).cast(pa.binary()).to_pylist():
                rolling.add(line + b"\n")
        rolling.close()
        return Written(folder, rolling.files)

    def commit(self, messages) -> None:
        store, target = file_system(self.path)
        store.create_dir(target, recursive=True)
        for message in messages:
            for file in message.files if message else ():
                store.move(f"{message.folder}/{file}", f"{target}/{file}")
        self.abort(messages)

    def abort(self, messages) -> None:
        store, stage = file_system(self.stage)
        if store.get_file_info(stage).type != fs.FileType.NotFound:
            store.delete_dir(stage)


class RollingLines(DataSource):
    """Options: path, lines_per_file, bytes_per_file. One text column; files are only ever added."""

    @classmethod
    def name(cls) -> str:
        return "rolling_lines"

    def writer(self, schema, overwrite: bool) -> RollingWriter:
        if overwrite:
            raise ValueError("files can only be added")
        return RollingWriter(self.options["path"], int(self.options.get("lines_per_file", LINES)), int(self.options.get("bytes_per_file", BYTES)))


def write_records(df: DataFrame, path: str, lines_per_file: int = LINES, bytes_per_file: int = BYTES) -> None:
    """Adds df's rows to a folder as gzipped lines of JSON. A file has at most so many lines, and so many bytes before
    compression unless one line alone is longer.
    """
    df.sparkSession.dataSource.register(RollingLines)
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("line"))
    lines.write.format("rolling_lines").mode("append").options(path=path, lines_per_file=lines_per_file, bytes_per_file=bytes_per_file).save()
