"""Hadoop file-system calls: small control files, directory names, byte totals. No row data goes through here."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Requests in flight at once against the file system.
CALLS_IN_FLIGHT = 32


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    bytes: int
    modified: dt.datetime


def each(action: Callable, items: Iterable) -> list:
    """Run a file-system call per item, a bounded number of them in flight."""
    items = list(items)
    if len(items) < 2:
        return [action(item) for item in items]
    with ThreadPoolExecutor(CALLS_IN_FLIGHT) as pool:
        return list(pool.map(action, items))


class Storage:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    @staticmethod
    def _entry(status) -> Entry:
        path = status.getPath()
        modified = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
        return Entry(path.toString(), path.getName(), status.isDirectory(), status.getLen(), modified)

    def exists(self, path: str) -> bool:
        p = self._path(path)
        return self._fs(p).exists(p)

    def list(self, path: str) -> list[Entry]:
        """Direct children, hidden ones included; nothing for a missing directory."""
        p = self._path(path)
        fs = self._fs(p)
        return [self._entry(s) for s in fs.listStatus(p)] if fs.exists(p) else []

    def glob(self, pattern: str) -> list[Entry]:
        p = self._path(pattern)
        return [self._entry(s) for s in (self._fs(p).globStatus(p) or [])]

    def read_text(self, path: str) -> str:
        p = self._path(path)
        stream = self._fs(p).open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        p = self._path(path)
        stream = self._fs(p).create(p, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def publish_text(self, path: str, text: str) -> None:
        """Make ``text`` appear at ``path`` in one step; fails when the path is taken."""
        p = self._path(path)
        staged = self._path(f"{p.getParent().toString()}/.{p.getName()}.{uuid.uuid4().hex}")
        self.write_text(staged.toString(), text)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs(p).getUri(), self._conf
        )
        keep_existing = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self._fs(p).makeQualified(staged), self._fs(p).makeQualified(p), keep_existing)
        finally:
            self._fs(staged).delete(staged, False)

    def qualified(self, path: str) -> str:
        """The path with scheme and authority."""
        p = self._path(path)
        return self._fs(p).makeQualified(p).toUri().toString()

    def make_dirs(self, path: str) -> None:
        p = self._path(path)
        self._fs(p).mkdirs(p)

    def delete(self, path: str) -> None:
        """Delete one file or a directory tree that the caller owns."""
        p = self._path(path)
        self._fs(p).delete(p, True)

    def usage(self, path: str) -> tuple[int, int]:
        """Bytes and number of files below ``path``, hidden and staged ones included."""
        p = self._path(path)
        fs = self._fs(p)
        if not fs.exists(p):
            return 0, 0
        summary = fs.getContentSummary(p)
        return summary.getLength(), summary.getFileCount()


def write_texts(texts: DataFrame, folder: str) -> int:
    """One file per row (``path`` below ``folder``, ``body``), written by the tasks; a file that exists is replaced.

    A task that runs again writes the same files once more. Tasks reach the store through Arrow's file systems, which
    know local paths, S3, HDFS, Google and Azure storage.
    """
    root = Storage(texts.sparkSession).qualified(folder)
    scheme, _, rest = root.partition(":")
    root = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + (rest if rest.startswith("//") else f"//{rest}")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(root)
        made: set[str] = set()
        written = 0
        for batch in batches:
            for path, body in zip(batch["path"].to_pylist(), batch["body"].to_pylist()):
                target = f"{base}/{path}"
                parent = target.rsplit("/", 1)[0]
                if parent not in made:
                    files.create_dir(parent, recursive=True)
                    made.add(parent)
                with files.open_output_stream(target) as out:
                    out.write(body.encode())
                written += 1
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["written"])

    done = texts.select("path", "body").mapInArrow(put, "written BIGINT").agg(F.sum("written"))
    return done.first()[0] or 0


def kept(frame: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read back: what comes later survives a lost executor without the work before."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """New folder for throwaway tables, below ``spark.checkpoint.dir`` so that every executor sees it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        return tempfile.mkdtemp(prefix=f"run-{label}-")
    folder = f"{shared.rstrip('/')}/run-{label}-{uuid.uuid4().hex[:12]}"
    Storage(spark).make_dirs(folder)
    return folder
