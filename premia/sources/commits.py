"""Files that appear whole and once: numbered commits for tables that several writers share.

``publish`` writes beside the target and then gives the file its name, which fails if the name is taken. Two writers
that want the same number therefore see one winner, and the loser tries the next number. A writer that dies leaves at
most a nameless file that nobody reads.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Digits of a commit number in a file name, so that names sort as numbers do.
DIGITS = 12


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(target)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the published files of a folder in ascending order."""
    fs, target = _path(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(n for n in (f.getPath().getName() for f in fs.listStatus(target)) if not n.startswith((".", "_")))


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, whole or not at all; False if it exists."""
    fs, target = _path(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            # A local rename replaces what is there; a link does not.
            try:
                os.link(urlparse(draft.toString()).path, urlparse(target.toString()).path)
                return True
            except FileExistsError:
                return False
        files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
        rename = spark.sparkContext._gateway.new_array(kinds, 1)
        rename[0] = kinds.NONE
        files.rename(draft, target, rename)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def commit(spark: SparkSession, folder: str, make: Callable[[int, list[str]], str]) -> int:
    """Publish the next numbered file of ``folder``; ``make`` gets its number and the names that were there before, and
    is asked again if another writer was first."""
    while True:
        taken = names(spark, folder)
        number = int(taken[-1].split(".")[0]) + 1 if taken else 1
        if publish(spark, f"{folder}/{number:0{DIGITS}d}.json", make(number, taken)):
            return number


def latest(spark: SparkSession, folder: str) -> dict | None:
    """The content of the last commit."""
    taken = names(spark, folder)
    return json.loads(read_text(spark, f"{folder}/{taken[-1]}")) if taken else None
