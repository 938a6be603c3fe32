"""Staged content and published objects on any file system that Arrow can open."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.operators.reconcile import (
    ALREADY_THERE,
    DOWNLOAD_FAILURE,
    MAX_ATTEMPTS,
    UPLOAD_FAILURE,
    UPLOADED,
)

CHUNK = 8 * 1024 * 1024
FIRST_WAIT_S = 1.0
OBJECTS = 5_000  # objects that one task puts, when there are many
FOLDERS = 256

OUTCOME_FIELDS = [
    StructField("s3_key", StringType()),
    StructField("content_type", StringType()),
    StructField("outcome", StringType()),
    StructField("attempts", LongType()),
    StructField("bytes", LongType()),
]


# A segment of a path that names its folder or the one above, also with escaped dots or separators.
_DOT, _CUT = r"(\.|%2[eE])", r"(/|\\|%2[fF]|%5[cC])"
_LEAVES = rf"(^|{_CUT}){_DOT}{{1,2}}({_CUT}|$)"


def url_path(url: Column) -> Column:
    """Where the content of a URL is staged below the content root: the URL without its scheme.

    NULL for a URL whose path would leave the root, or that has no host: URLs come from the remote side.
    """
    path = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*:(//)?", "")
    unsafe = F.rlike(path, F.lit(_LEAVES)) | F.rlike(path, F.lit(rf"^({_CUT}|$)")) | F.contains(path, F.lit("\0"))
    return F.when(~unsafe, path)


def staged_path(root: str, url: Column) -> Column:
    """The staged content of a URL, or NULL where there can be none."""
    return F.concat(F.lit(root.rstrip("/") + "/"), url_path(url))


@lru_cache(maxsize=32)
def _remote_fs(scheme: str, authority: str):
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(f"{scheme}://{authority}/x")
    return store, path.removesuffix("x")


def _open_fs(uri: str):
    """The file system of a path, and the path on it; one client per store and Python worker."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    scheme, rest = uri.split("://", 1)
    authority, _, path = rest.partition("/")
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme  # Hadoop's names of the same store
    store, base = _remote_fs(scheme, authority)
    return store, base + path


def _open_root(uri: str):
    """Like ``_open_fs`` for the object root, which may carry options such as
    ``?endpoint_override=...``."""
    if "://" not in uri or "?" not in uri:
        return _open_fs(uri)
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _exists(store, path: str) -> bool | None:
    """Whether there is an object; a folder is none. None when the store does not say."""
    from pyarrow import fs

    try:
        return store.get_file_info(path).type == fs.FileType.File
    except (OSError, ValueError):
        return None


def _inside(root: str, key: str) -> str | None:
    """The object's path, or None for a key that would leave the store."""
    if any(part in (".", "..") for part in key.split("/")):
        return None
    return f"{root.rstrip('/')}/{key}"


class _Folders:
    """The folders that a task puts objects into, each with one below it for parts that only this task writes.

    Tasks that make files in one folder wait for each other, so a part costs the shared folder one rename."""

    def __init__(self, store):
        self.store, self.own = store, {}

    def part(self, folder: str) -> str:
        """A new name for a part of an object in ``folder``."""
        if folder not in self.own:
            own = f"{folder}/.{uuid.uuid4().hex}.parts"
            self.store.create_dir(own, recursive=True)
            self.own[folder] = own
        return f"{self.own[folder]}/{uuid.uuid4().hex}"

    def forget(self, folder: str) -> None:
        """Make it anew next time: a put has failed, and it may be gone."""
        own = self.own.pop(folder, None)
        if own:
            try:
                self.store.delete_dir(own)
            except OSError:
                pass

    def close(self) -> None:
        for folder in list(self.own):
            self.forget(folder)


def _copy(source, source_path: str, store, path: str, mime: str, folders: _Folders) -> int:
    """Copy in chunks. A key never shows half an object: a put to an object store is whole or
    nothing, and file systems get a name of its own first, which is then renamed."""
    if store.type_name not in ("local", "hdfs"):
        return _write(source, source_path, store, path, mime)
    folder = path.rsplit("/", 1)[0]
    try:
        part = folders.part(folder)
        size = _write(source, source_path, store, part, mime)
        store.move(part, path)
    except BaseException:
        folders.forget(folder)
        raise
    return size


def _write(source, source_path: str, store, path: str, mime: str) -> int:
    size = 0
    with (
        source.open_input_stream(source_path, compression=None) as src,
        store.open_output_stream(path, compression=None, metadata={"Content-Type": mime}) as dst,
    ):
        while chunk := src.read(CHUNK):
            dst.write(chunk)
            size += len(chunk)
    return size


class _Row(NamedTuple):
    """A row to publish: its object's key and type, its content's path, and whether the object is there."""

    key: str
    content: str | None
    mime: str
    there: bool | None


Outcome = tuple[str, int, int]  # what became of a row, attempts, bytes


def _put(store, path: str | None, row: _Row, attempt: int, folders: _Folders) -> Outcome | None:
    """One attempt to publish a row; None if it should be tried again."""
    if path is None:
        return UPLOAD_FAILURE, 0, 0
    if not isinstance(row.content, str):
        return DOWNLOAD_FAILURE, 0, 0
    try:  # Arrow's errors about names and URIs are ValueErrors
        source, source_path = _open_fs(row.content)
        if attempt == 1 and not source.get_file_info(source_path).size:
            return DOWNLOAD_FAILURE, 0, 0
    except (OSError, ValueError):
        return DOWNLOAD_FAILURE, 0, 0
    if attempt == 1 and (_exists(store, path) if row.there is None else row.there):
        return ALREADY_THERE, 0, 0
    try:
        return UPLOADED, attempt, _copy(source, source_path, store, path, row.mime, folders)
    except (OSError, ValueError):
        if _exists(store, path):  # a second run of the same task was faster
            return ALREADY_THERE, attempt, 0
    return None


def _publish_all(store, root: str, rows: list[_Row], wait_s: float, folders: _Folders) -> list[Outcome]:
    """Publish rows in their order, and those that fail again after all others, so that they share a wait."""
    paths = [_inside(root, row.key) for row in rows]
    done: list[Outcome | None] = [None] * len(rows)
    left, put = range(len(rows)), set()
    for attempt in range(1, MAX_ATTEMPTS + 1):
        if attempt > 1:
            time.sleep(wait_s * 2 ** (attempt - 2))
        for i in left:
            if attempt > 1 and paths[i] in put:  # by a later row of the same key
                done[i] = ALREADY_THERE, attempt - 1, 0
            else:
                done[i] = _put(store, paths[i], rows[i], attempt, folders)
            if done[i] and done[i][0] == UPLOADED:
                put.add(paths[i])
        left = [i for i in left if done[i] is None]
        if not left:
            break
    return [d or (UPLOAD_FAILURE, MAX_ATTEMPTS, 0) for d in done]


def _publish_one(
    store, root: str, key: str, content: str | None, mime: str, there: bool | None, wait_s: float
) -> Outcome:
    folders = _Folders(store)
    try:
        return _publish_all(store, root, [_Row(key, content, mime, there)], wait_s, folders)[0]
    finally:
        folders.close()


def put_tasks(spark: SparkSession, rows: int) -> int:
    """In how many tasks to put so many objects: more of them for more rows, not longer ones."""
    return max(4 * spark.sparkContext.defaultParallelism, -(-rows // OBJECTS))


def put_objects(
    rows: DataFrame, root: str, keys: list[str], tasks: int, wait_s: float = FIRST_WAIT_S
) -> DataFrame:
    """Copy staged content to its object key, on the executors, one object at a time per task. Rows that fail
    are tried again after the others of their batch: ``wait_s`` later, twice that, and so on.

    ``rows`` has the keys, ``s3_key``, ``content_type``, ``content_path`` and ``object_exists``; where
    the latter is NULL the store is asked. A task that is run again finds the objects of its first run
    in place. Only names travel to Python, so the memory of a task does not depend on the size of the
    objects.
    """
    fields = [rows.schema[k] for k in keys] + OUTCOME_FIELDS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open_root(root)
        folders = _Folders(store)
        try:
            for pdf in batches:
                asked = [
                    _Row(row.s3_key, row.content_path, row.content_type, None if pd.isna(row.object_exists) else bool(row.object_exists))
                    for row in pdf.itertuples(index=False)
                ]
                done = _publish_all(store, base, asked, wait_s, folders)
                out = pdf[[*keys, "s3_key", "content_type"]].copy()
                out["outcome"] = [d[0] for d in done]
                out["attempts"] = [d[1] for d in done]
                out["bytes"] = [d[2] for d in done]
                yield out
        finally:
            folders.close()

    named = rows.select(*keys, "s3_key", "content_type", "content_path", "object_exists")
    return named.repartition(tasks, *keys).mapInPandas(run, StructType(fields))


def spread(name: Column) -> Column:
    """One of ``FOLDERS`` folders, by the name alone."""
    return F.lower(F.hex(F.pmod(F.xxhash64(name), F.lit(FOLDERS))))


def write_contents(rows: DataFrame) -> DataFrame:
    """Write each row's ``text`` to the file ``path`` and return path and bytes. Empty texts too.

    Tasks that write to one folder wait for each other; ``spread`` deals names out to many.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = set()
        for pdf in batches:
            sizes = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                body = (text or "").encode()
                store, at = _open_fs(path)
                folder = path.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    made.add(folder)
                with store.open_output_stream(at, compression=None) as out:
                    out.write(body)
                sizes.append(len(body))
            yield pd.DataFrame({"path": pdf["path"], "bytes": sizes}, columns=["path", "bytes"])

    return rows.select("path", "text").mapInPandas(run, "path string, bytes long")
