"""Folder listing through the Hadoop file system the session is set up for."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def labelled_folders(spark: SparkSession, root: str, label: str) -> dict[str, int]:
    """``{value: modification time in ms}`` of the ``root/label=value`` folders,
    from one listing of ``root``."""
    path, fs = _open(spark, root)
    if not fs.exists(path):
        return {}
    found = {}
    for status in fs.listStatus(path):
        name, _, value = status.getPath().getName().partition("=")
        if name == label:
            found[value] = status.getModificationTime()
    return found


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether the write of a folder was committed."""
    marker, fs = _open(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def finished_batches(spark: SparkSession, root: str, folded: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """Writer, number and time in ms of the committed batches below ``root``: one listing
    per writer, and one look at each batch that is not ``folded`` yet."""
    path, fs = _open(spark, f"{root}/writer=*/batch_id=*")
    found = []
    for status in fs.globStatus(path) or []:
        folder = status.getPath()
        writer, batch = folder.getParent().getName().partition("=")[2], int(folder.getName().partition("=")[2])
        if batch <= folded.get(writer, -1) or is_finished(spark, folder.toString()):
            found.append((writer, batch, status.getModificationTime()))
    return found


def numbered_files(spark: SparkSession, root: str) -> dict[int, str]:
    """``{number: path}`` of the files ``root/<number>.json``."""
    path, fs = _open(spark, f"{root}/[0-9]*.json")
    names = [s.getPath() for s in fs.globStatus(path) or []]
    return {int(p.getName().partition(".")[0]): p.toString() for p in names}


def read_text(spark: SparkSession, path: str) -> str:
    hadoop, fs = _open(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file whole, or not at all; False if there is one of that name."""
    draft, fs = _open(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    target, _ = _open(spark, path)
    done = not fs.exists(target) and fs.rename(draft, target)
    if not done:
        fs.delete(draft, False)
    return done


def move(spark: SparkSession, path: str, target: str) -> bool:
    hadoop, fs = _open(spark, path)
    goal, _ = _open(spark, target)
    fs.mkdirs(goal.getParent())
    return fs.rename(hadoop, goal)


def remove(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _open(spark, path)
    return fs.delete(hadoop, True)


def newest_child(spark: SparkSession, root: str, pattern: str = "*") -> str | None:
    """Child of ``root`` with the latest modification time; None for a missing
    or empty folder."""
    path, fs = _open(spark, f"{root}/{pattern}")
    children = [(s.getModificationTime(), s.getPath().toString())
                for s in fs.globStatus(path) or []]
    return max(children)[1] if children else None
