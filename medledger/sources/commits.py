"""Numbered commit files in a shared folder: each is made once, whole, by one writer.

A commit is a small JSON file ``00000007.json``. Its number is claimed by making the file exclusively, so of two writers
one gets the number and the other tries the next; readers see a commit with all its text or not at all.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 8


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:0{DIGITS}d}.json"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers that are taken, in order. One listing of the folder, which holds a small file a commit."""
    where, files = _path(spark, folder)
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read(spark: SparkSession, folder: str, number: int) -> dict:
    where, files = _path(spark, _file(folder, number))
    stream = files.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _path(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, folder: str, number: int) -> None:
    delete_folder(spark, _file(folder, number))


def delete_folder(spark: SparkSession, path: str) -> None:
    where, files = _path(spark, path)
    files.delete(where, True)


def create(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Make commit ``number``; False, with nothing changed, if it is there already.

    The text is written beside the target and brought there by a step that refuses an existing target: a hard link on a
    local file system, else the file system's rename, which HDFS refuses likewise. A store without such a rename needs a
    committer of its own.
    """
    target, files = _path(spark, _file(folder, number))
    beside, _ = _path(spark, f"{folder}/_{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    if files.exists(target):
        return False
    out = files.create(beside, False)
    try:
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        out.close()
    try:
        if files.getScheme() != "file":
            return bool(files.rename(beside, target))
        os.link(beside.toUri().getPath(), target.toUri().getPath())
        return True
    except (FileExistsError, Py4JJavaError):
        if files.exists(target):
            return False
        raise
    finally:
        if files.exists(beside):
            files.delete(beside, False)


def claim_next(spark: SparkSession, folder: str, content: dict, at_least: int = 1) -> int:
    """The next free number, from ``at_least`` on, now taken by the caller."""
    number = max(at_least, *(n + 1 for n in numbers(spark, folder)[-1:]), 1)
    while not create(spark, folder, number, content):
        number += 1
    return number
