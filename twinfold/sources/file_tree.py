"""Walking, reading and writing file trees by tasks.

A walk has one round per level of folders: the folders found so far are dealt over tasks, each task lists its
own, and the listings are stored. Files are rows of these tables, folders the next round's input; the driver
sees neither. A folder is listed by one task as a stream, since a listing is sequential.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.sources.scratch import stored

#: Rows of a listing that are handed on at a time, and bytes of contents.
LIST_ROWS, CONTENT_BYTES = 10_000, 32_000_000
#: Contents from this size on can't be a row's value; such a file has null content.
MOST_BYTES = 2_000_000_000
_LISTED = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("file_size", pa.int64()), ("mtime", pa.timestamp("us", "UTC"))])


def local_path(path: str) -> str:
    """A path or file: address as the operating system knows it."""
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def listable(path: str) -> bool:
    """Whether tasks can list and read there by themselves: mounted folders."""
    return path.startswith("file:") or "://" not in path


def entries(folder: str) -> Iterator[tuple[str, bool, int, datetime]]:
    """(path, is a folder, size, time) of what lies in a folder. Links to files count as files, links to folders aren't followed.

    What vanishes meanwhile, can't be read or has a name that isn't UTF-8 is left out.
    """
    try:
        found = os.scandir(folder)
    except OSError:
        return
    with found:
        for x in found:
            try:
                x.path.encode()
                if x.is_dir(follow_symlinks=False):
                    yield x.path, True, 0, datetime.fromtimestamp(0, timezone.utc)
                elif x.is_file():
                    info = x.stat()
                    yield x.path, False, info.st_size, datetime.fromtimestamp(info.st_mtime, timezone.utc)
            except (OSError, UnicodeEncodeError):
                continue


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            for row in entries(folder):
                rows.append(row)
                if len(rows) == LIST_ROWS:
                    yield pa.RecordBatch.from_pylist([dict(zip(_LISTED.names, r)) for r in rows], schema=_LISTED)
                    rows.clear()
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(_LISTED.names, r)) for r in rows], schema=_LISTED)


def walk(spark: SparkSession, root: str) -> DataFrame:
    """source_path (file:/...), filename, mtime, file_size of all regular files below root."""
    front = spark.createDataFrame([(local_path(root),)], "path string")
    levels: list[DataFrame] = []
    while True:
        found = stored(front.mapInArrow(_listed, "path string, is_folder boolean, file_size long, mtime timestamp"), "listing")
        levels.append(found.filter("NOT is_folder"))
        folders = found.filter("is_folder").select("path")
        n = folders.count()
        if not n:
            break
        # Random parts: neighbouring folders may be of very different size.
        front = folders.repartition(min(n, max(64, spark.sparkContext.defaultParallelism * 4)))
    files = reduce(DataFrame.unionByName, levels)
    return files.select(F.concat(F.lit("file:"), "path").alias("source_path"), F.element_at(F.split("path", "/"), -1).alias("filename"), "mtime", "file_size")


def read_contents(files: DataFrame) -> DataFrame:
    """files (source_path and others) plus content, the whole file; null where it can't be read any more or is too large for a row."""
    names = files.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in files.dtypes) + ", content binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, start, room = [], 0, 0
            for k, path in enumerate(batch.column("source_path").to_pylist()):
                try:
                    with open(local_path(path), "rb") as file:
                        data = file.read(MOST_BYTES + 1)
                except OSError:
                    data = None
                held.append(data if data is not None and len(data) <= MOST_BYTES else None)
                room += len(held[-1] or b"")
                if room > CONTENT_BYTES or k == batch.num_rows - 1:
                    part = batch.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(held, pa.binary())], names=[*names, "content"])
                    start, held, room = k + 1, [], 0

    return files.mapInArrow(read, schema)


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Write files (path, relative to root, and content) to a mounted folder: path, done, error. Existing ones are replaced as a whole."""
    where = local_path(root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in batch[["path", "content"]].itertuples(index=False, name=None):
                target = f"{where}/{path}"
                part = f"{os.path.dirname(target)}/.{uuid.uuid4().hex}.part"
                try:
                    os.makedirs(os.path.dirname(target), exist_ok=True)
                    with open(part, "wb") as file:
                        file.write(content)
                    os.replace(part, target)
                    out.append((path, True, None))
                except OSError as error:
                    out.append((path, False, str(error)))
            yield pd.DataFrame(out, columns=["path", "done", "error"], dtype=object)

    return files.mapInPandas(run, "path string, done boolean, error string")
