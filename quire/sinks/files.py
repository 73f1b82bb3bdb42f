"""One file per row, written by the executors and committed as a whole (K1/K6, text-directory fixtures).

A write has two steps:

1. *Staging.*  A Python data source writes the files of each task attempt to a
   folder of its own below ``<directory>/_writing-<id>``, and their names to a
   list beside it.  Only attempts that Spark commits are told to the driver, by
   one message a task; ``commit`` puts them into the marker ``_committed``.
   ``abort`` removes the folder, so a job that fails leaves what was there.
2. *Publication*, after the marker only: in place of an older output tasks
   remove the files that are not in the lists, then they rename the staged files
   to their final names.  Every move can be repeated, so lost executors cost nothing;
   where the driver itself is lost, the next write or ``finish_writes`` goes on
   from the marker, and clears what has none.

Names never pass through the driver.  Readers of Spark leave out ``_writing-*``.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import BinaryType

STAGING = "_writing-"
MARKER = "_committed"
# Schemes of Hadoop that pyarrow knows by another name (fixed values).
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark itself would read it by (``fs.defaultFS`` when it has none)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def resolved(spark: SparkSession, path: str) -> str:
    """``path`` in the store that holds it: Hadoop follows its mount tables (``viewfs``) from the nearest folder that exists."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(qualified(spark, path))
    fs, below = p.getFileSystem(sc._jsc.hadoopConfiguration()), []
    while not fs.exists(p) and p.getParent() is not None:
        below.append(p.getName())
        p = p.getParent()
    return "/".join([fs.resolvePath(p).toString().rstrip("/"), *reversed(below)])


def _store(uri: str):
    """``(pyarrow file system, path in it)`` of a qualified path."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    except Exception as e:
        raise ValueError(f"files cannot be written one by one to {scheme}: ({e})") from e


def _checked(name: str | None) -> str:
    parts = (name or "").split("/")
    if any(p in ("", ".", "..") for p in parts) or any(p[0] in "_." for p in parts):
        raise ValueError(f"not a file name that a reader would find below the folder: {name!r}")
    return name


@dataclass
class _Staged(WriterCommitMessage):
    task: str
    files: int


class _StagingWriter(DataSourceWriter):
    def __init__(self, staging: str):
        self._staging = staging

    def write(self, iterator: Iterator) -> _Staged:
        store, root = _store(self._staging)
        task, names, made = uuid.uuid4().hex, [], set()
        for name, content in iterator:
            at = f"{root}/files/{task}/{_checked(name)}"
            folder = at.rsplit("/", 1)[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            data = bytes(content or b"")
            with store.open_output_stream(at) as out:
                out.write(data)
            names.append(json.dumps({"name": name, "bytes": len(data), "task": task}) + "\n")
        if names:
            store.create_dir(f"{root}/names", recursive=True)
            with store.open_output_stream(f"{root}/names/{task}.json") as out:
                out.write("".join(names).encode())
        return _Staged(task, len(names))

    def commit(self, messages: list) -> None:
        store, root = _store(self._staging)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MARKER}") as out:
            out.write(json.dumps([m.task for m in messages if m is not None and m.files]).encode())

    def abort(self, messages: list) -> None:
        _clear(self._staging)


class _StagedFiles(DataSource):
    """Sink of rows ``(name STRING, content BINARY)`` below the option ``staging``."""

    @classmethod
    def name(cls) -> str:
        return "quire_staged_files"

    def writer(self, schema, overwrite: bool) -> _StagingWriter:
        return _StagingWriter(self.options["staging"])


def _remove(store, root: str) -> bool:
    from pyarrow import fs

    there = store.get_file_info(root).type == fs.FileType.Directory
    if there:
        store.delete_dir(root)
    return there


def _clear(staging: str, quiet: float = 1.0, most: float = 30.0) -> None:
    """Remove the folder of a failed write until nothing has come back for ``quiet`` seconds: tasks of the job that
    still run while it is aborted go on writing until they are ended."""
    store, root = _store(staging)
    begun = last = time.monotonic()
    while time.monotonic() - last < quiet and time.monotonic() - begun < most:
        try:
            if _remove(store, root):
                last = time.monotonic()
        except OSError:  # a file came in meanwhile
            last = time.monotonic()
        time.sleep(0.1)


def _move(store, source: str, target: str) -> None:
    """Rename, over an older file too; nothing to do where an earlier try has done it."""
    from pyarrow import fs

    if store.get_file_info(source).type == fs.FileType.NotFound:
        if store.get_file_info(target).type == fs.FileType.NotFound:
            raise FileNotFoundError(source)
        return
    try:
        store.move(source, target)
    except OSError:
        store.delete_file(target)
        store.move(source, target)


def _staged_names(spark: SparkSession, staging: str, tasks: list[str]) -> DataFrame:
    """``(name, bytes, task)`` of the committed attempts."""
    schema = "name STRING, bytes BIGINT, task STRING"
    if not tasks:
        return spark.createDataFrame([], schema)
    names = spark.read.schema(schema).json(f"{staging}/names")
    return names.join(F.broadcast(spark.createDataFrame([(t,) for t in tasks], "task STRING")), "task", "left_semi")


def _publish(spark: SparkSession, base: str, staging: str, replace: bool) -> None:
    """Step 2 for one staging folder that has its marker."""
    store, root = _store(staging)
    with store.open_input_stream(f"{root}/{MARKER}") as f:
        tasks = json.loads(f.read())
    names = _staged_names(spark, staging, tasks)

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(staging)
        _, final = _store(base)
        made = set()
        for pdf in batches:
            for name, task in zip(pdf["name"], pdf["task"]):
                folder = f"{final}/{name}".rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                _move(store, f"{root}/files/{task}/{name}", f"{final}/{name}")
            yield pd.DataFrame({"moved": [len(pdf)]})

    if replace:

        def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, final = _store(base)
            for pdf in batches:
                for name in pdf["name"]:
                    try:
                        store.delete_file(f"{final}/{name}")
                    except FileNotFoundError:  # an earlier try has removed it
                        pass
                yield pd.DataFrame({"removed": [len(pdf)]})

        # Before the moves: what is listed is the older output, not the new files too.
        stale = written_files(spark, base).select("name").join(names, "name", "left_anti")
        stale.mapInPandas(remove, "removed BIGINT").agg(F.sum("removed")).collect()  # one row
    names.mapInPandas(move, "moved BIGINT").agg(F.sum("moved")).collect()  # one row
    _remove(store, root)


def finish_writes(spark: SparkSession, directory: str, replace: bool = True) -> None:
    """Publish what earlier writes to ``directory`` committed but did not publish, and clear what they did not commit."""
    from pyarrow import fs

    base = resolved(spark, directory)
    store, root = _store(base)
    for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if info.base_name.startswith(STAGING):
            if store.get_file_info(f"{info.path}/{MARKER}").type == fs.FileType.File:
                _publish(spark, base, f"{base}/{info.base_name}", replace)
            else:
                _remove(store, info.path)


def _ours(name: str) -> bool:
    """Hidden names are not ours: staging, success marks, checksums."""
    return name[0] not in "_."


def _read_by_spark(name: str) -> bool:
    """Names that Spark's readers take below a folder."""
    return not (name[0] == "." or name[0] == "_" and "=" not in name or name.endswith("._COPYING_"))


def _listed(store, root: str, shown: Callable[[str], bool] = _ours, into: Callable[[str], bool] = lambda name: True) -> Iterator[tuple[str, int]]:
    """``(name, bytes)`` of the files below ``root``, folder by folder; a local folder is read entry by entry, never
    held as a list.  Names that are not ``shown`` are left out, folders too; only folders ``into`` allows are gone into."""
    from pyarrow import fs

    folders = [root]
    while folders:
        folder = folders.pop()
        if isinstance(store, fs.LocalFileSystem):
            if not os.path.isdir(folder):
                continue
            with os.scandir(folder) as entries:
                for e in entries:
                    if not shown(e.name):
                        continue
                    if e.is_dir():
                        if into(e.name):
                            folders.append(e.path)
                    elif e.is_file():
                        yield e.path[len(root) :].strip("/"), e.stat().st_size
        else:
            for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if not shown(info.base_name):
                    continue
                if info.type == fs.FileType.Directory:
                    if into(info.base_name):
                        folders.append(info.path)
                elif info.type == fs.FileType.File:
                    yield info.path[len(root) :].strip("/"), info.size


def _in_one_task(spark: SparkSession, base: str, listed: Callable) -> DataFrame:
    """``(name, bytes)`` that ``listed(store, root)`` gives, by one task, as a store lists a folder in sequence."""

    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(base)
        for _ in batches:
            names = iter(listed(store, root))
            while some := list(islice(names, 10_000)):
                yield pd.DataFrame(some, columns=["name", "bytes"])

    return spark.range(1).mapInPandas(listing, "name STRING, bytes BIGINT")


def written_files(spark: SparkSession, directory: str) -> DataFrame:
    """``(name, bytes)`` of the files below ``directory``, empty ones too, names relative to it."""
    return _in_one_task(spark, resolved(spark, directory), _listed)


def found_files(spark: SparkSession, base: str, glob: str, recursive: bool) -> DataFrame:
    """``(name, bytes)`` of the files in the folder ``base`` (as ``resolved`` gives it) that Spark's readers take and whose
    base name matches ``glob``; without ``recursive`` only folders ``key=value`` are gone into, as Spark does."""
    # Hadoop's own reading of the pattern.
    pattern = re.compile(spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().toString(), re.DOTALL)

    def listed(store, root: str) -> Iterator[tuple[str, int]]:
        files = _listed(store, root, _read_by_spark, lambda name: recursive or "=" in name)
        return ((name, size) for name, size in files if pattern.fullmatch(name.rsplit("/", 1)[-1]))

    return _in_one_task(spark, base, listed)


def contents(names: DataFrame, base: str) -> DataFrame:
    """``(name, content)`` of the files ``name`` below ``base``: each is read whole by the task that has its name."""
    return names.select("name").mapInArrow(lambda batches: _read(batches, base), "name STRING, content BINARY")


def _read(batches: Iterator[pa.RecordBatch], base: str, at_once: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Files named in ``batches``, given on as soon as ``at_once`` bytes are held."""
    store, root = _store(base)
    for batch in batches:
        some, size = [], 0
        for name in batch.column("name").to_pylist():
            with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                some.append((name, f.read()))
            size += len(some[-1][1])
            if size >= at_once:
                yield _as_batch(some)
                some, size = [], 0
        if some:
            yield _as_batch(some)


def _as_batch(some: list[tuple[str, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n for n, _ in some], pa.string()), pa.array([c for _, c in some], pa.binary())], names=["name", "content"])


def write_text_files(df: DataFrame, directory: str, name_col: str, text_col: str, replace: bool = True) -> DataFrame:
    """Write ``text_col`` of each row to ``directory/<name_col>`` (UTF-8, or bytes as they are; null as an empty file).

    The files take the place of those in ``directory`` once all are written;
    with ``replace=False`` other files there stay.  Names may have folders, no
    part of a name may begin with ``_`` or ``.``; two rows of one name, or a
    null name, raise and leave the folder as it was.  One writer at a time.
    Returns ``(name, bytes)`` of the files there (lazy).
    """
    from ..operators.util import ship_package

    spark = df.sparkSession
    ship_package(spark)
    base = resolved(spark, directory)
    store, root = _store(base)
    store.create_dir(root, recursive=True)
    finish_writes(spark, base, replace)
    staging = f"{base}/{STAGING}{uuid.uuid4().hex}"
    binary = isinstance(df.schema[text_col].dataType, BinaryType)
    content = F.col(text_col) if binary else F.encode(F.col(text_col).cast("string"), "UTF-8")
    spark.dataSource.register(_StagedFiles)
    rows = df.select(F.col(name_col).cast("string").alias("name"), content.alias("content"))
    try:
        rows.write.format(_StagedFiles.name()).option("staging", staging).mode("append").save()
    except Exception:
        # Spark looks every 2 seconds whether a task was ended, and gives its Python worker 2 more before it ends that too.
        _clear(staging, quiet=5.0)
        raise
    _, inner = _store(staging)
    with store.open_input_stream(f"{inner}/{MARKER}") as f:
        tasks = json.loads(f.read())
    twice = _staged_names(spark, staging, tasks).groupBy("name").count().where("count > 1").select("name").take(3)
    if twice:
        _remove(store, inner)
        raise ValueError(f"file names have to be unique: {[r['name'] for r in twice]}")
    _publish(spark, base, staging, replace)
    return written_files(spark, base)
