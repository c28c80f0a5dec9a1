"""Bulk files whose manifest comes from the tasks that wrote them, so nothing is read twice.

A data source for writing lines of text: every task writes files of at most ``rows`` lines into the job's own folder and
reports their names, lines and bytes. Only when all tasks are done are the reported files moved into place and the
manifest written beside them; what failed or repeated tasks left goes with the job's folder.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "manifested_lines"
MANIFEST = "_manifest.json"
NIL = "NIL"


def _open(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path, by its scheme; a path without one is a shared folder."""
    return files.FileSystem.from_uri(path) if "://" in path else (files.LocalFileSystem(), path.removeprefix("file:"))


@dataclass
class _Written(WriterCommitMessage):
    """What one task has written: name, lines and bytes of every file."""

    parts: list[tuple[str, int, int]]


class _LineWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.rows, self.overwrite = options["path"].rstrip("/"), int(options["rows"]), overwrite
        self.job = uuid.uuid4().hex[:12]

    @property
    def folder(self) -> str:
        return f"_writing-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        task = TaskContext.get()
        system, root = _open(self.path)
        folder = posixpath.join(root, self.folder)
        system.create_dir(folder, recursive=True)
        parts: list[tuple[str, int, int]] = []
        out, lines = None, 0

        def close() -> None:
            nonlocal parts
            parts[-1] = (parts[-1][0], lines, out.tell())
            out.close()

        for batch in iterator:
            start = 0
            while start < batch.num_rows:
                if out is None or lines == self.rows:
                    if out is not None:
                        close()
                    name = f"part-{task.partitionId():05d}-{len(parts):04d}-{self.job}-{task.taskAttemptId()}.tsv"
                    out, lines = system.open_output_stream(posixpath.join(folder, name)), 0
                    parts.append((name, 0, 0))
                taken = batch.column(0).slice(start, self.rows - lines)
                out.write(("\n".join(taken.to_pylist()) + "\n").encode())
                lines += len(taken)
                start += len(taken)
        if out is not None:
            close()
        return _Written(parts)

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        kept = [part for message in messages if message for part in message.parts]
        listed = system.get_file_info(files.FileSelector(root))
        old = [i.path for i in listed if i.type == files.FileType.File and i.base_name.startswith("part-")]
        before = [] if self.overwrite else _manifest_rows(system, root)
        for name, _, _ in kept:
            system.move(posixpath.join(root, self.folder, name), posixpath.join(root, name))
        rows = before + [{"path": f"{self.path}/{name}", "lines": lines, "bytes": size} for name, lines, size in kept]
        fresh = posixpath.join(root, f"_manifest-{self.job}")
        with system.open_output_stream(fresh) as out:
            out.write("".join(json.dumps(row) + "\n" for row in rows).encode())
        system.move(fresh, posixpath.join(root, MANIFEST))
        if self.overwrite:
            for path in old:
                system.delete_file(path)
        self._clear(system, root)

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear(*_open(self.path))

    def _clear(self, system: files.FileSystem, root: str) -> None:
        folder = posixpath.join(root, self.folder)
        if system.get_file_info(folder).type == files.FileType.Directory:
            system.delete_dir(folder)


def _manifest_rows(system: files.FileSystem, root: str) -> list[dict]:
    path = posixpath.join(root, MANIFEST)
    if system.get_file_info(path).type != files.FileType.File:
        return []
    with system.open_input_stream(path) as source:
        return [json.loads(line) for line in source.read().decode().splitlines()]


class _Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> _LineWriter:
        return _LineWriter(dict(self.options), overwrite)


def as_lines(df: DataFrame) -> DataFrame:
    """Tab-separated text of every row, ``NIL`` for null. Text fields hold no tabs and line ends (JSON escapes them)."""
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NIL)) for c in df.columns]).alias("value"))


def export_manifested(df: DataFrame, path: str, rows_per_file: int, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` tab-separated, at most ``rows_per_file`` lines to a file; gives the manifest (path, lines, bytes).

    ``path`` is a folder that all tasks reach: shared, or in a store that Arrow opens (``s3://``, ``gs://``, ``hdfs://``).
    ``overwrite`` replaces the folder's parts once the new ones are in place, ``append`` adds to files and manifest. Tasks
    without rows write no file; an empty table leaves an empty manifest. The driver learns one line a file.
    """
    spark = df.sparkSession
    spark.dataSource.register(_Lines)
    as_lines(df).write.format(FORMAT).mode(mode).option("path", path).option("rows", rows_per_file).save()
    return manifest_of(spark, path)


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """The manifest that the last export wrote."""
    return spark.createDataFrame(
        [(r["path"], r["lines"], r["bytes"]) for r in _manifest_rows(*_open(path.rstrip("/")))], "path string, lines long, bytes long")
