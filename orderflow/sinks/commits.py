"""Which batch folders below a path are complete.

Spark's file writers leave a marker in a folder once all of it is in place. Only
names are listed: one listing finds the batches, and markers are looked up for
those that matter.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_MARKER = "_SUCCESS"


def _path(spark: SparkSession, text: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def _store(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbered(spark: SparkSession, root: str, prefix: str) -> dict[int, str]:
    """Batch number to folder name; none if nothing was stored yet."""
    path = _path(spark, root)
    store = _store(spark, path)
    if not store.exists(path):
        return {}
    names = [status.getPath().getName() for status in store.listStatus(path)]
    matches = [re.fullmatch(rf"{prefix}(\d+)", name) for name in names]
    return {int(m[1]): m[0] for m in matches if m}


def _is_committed(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{_MARKER}")


def exists(spark: SparkSession, text: str) -> bool:
    path = _path(spark, text)
    return _store(spark, path).exists(path)


def make_folder(spark: SparkSession, text: str) -> None:
    path = _path(spark, text)
    _store(spark, path).mkdirs(path)


def delete(spark: SparkSession, text: str) -> None:
    path = _path(spark, text)
    _store(spark, path).delete(path, True)


def folders_matching(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Names of the complete folders below root that match a pattern."""
    path = _path(spark, root)
    store = _store(spark, path)
    if not store.exists(path):
        return []
    names = sorted(status.getPath().getName() for status in store.listStatus(path))
    return [n for n in names if re.fullmatch(pattern, n) and _is_committed(spark, f"{root}/{n}")]


def publish(spark: SparkSession, root: str, name: str, text: str) -> None:
    """Put a small file in place at once: readers see the old text or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path, draft = _path(spark, f"{root}/{name}"), _path(spark, f"{root}/.{name}.{uuid.uuid4().hex}")
    stream = _store(spark, draft).create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf).rename(draft, path, options)


def published(spark: SparkSession, root: str, name: str) -> str | None:
    """The text of a published file; None if there is none."""
    path = _path(spark, f"{root}/{name}")
    store = _store(spark, path)
    if not store.exists(path):
        return None
    stream = store.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folder_names(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Names of the folders below root that match a pattern, complete or not."""
    path = _path(spark, root)
    names = [status.getPath().getName() for status in _store(spark, path).listStatus(path)]
    return sorted(n for n in names if re.fullmatch(pattern, n))


def drop_newer(spark: SparkSession, root: str, prefix: str, last: int) -> None:
    """Delete the batches after ``last``: what a replay did not reach."""
    for number, name in _numbered(spark, root, prefix).items():
        if number > last:
            delete(spark, f"{root}/{name}")


def committed_batches(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Folders of all complete batches, oldest first."""
    folders = [f"{root}/{name}" for _, name in sorted(_numbered(spark, root, prefix).items())]
    return [folder for folder in folders if _is_committed(spark, folder)]


def newest_batch(spark: SparkSession, root: str, prefix: str) -> str | None:
    """Folder of the newest complete batch; looks no further back than needed."""
    for _, name in sorted(_numbered(spark, root, prefix).items(), reverse=True):
        if _is_committed(spark, f"{root}/{name}"):
            return f"{root}/{name}"
    return None


def drop_older(spark: SparkSession, root: str, prefix: str, keep: int) -> None:
    """Delete all but the ``keep`` newest complete batches and what came after them."""
    names = sorted(_numbered(spark, root, prefix).items(), reverse=True)
    complete = [n for n, name in names if _is_committed(spark, f"{root}/{name}")][:keep]
    if len(complete) < keep:
        return
    for number, name in names:
        if number < complete[-1]:
            delete(spark, f"{root}/{name}")
