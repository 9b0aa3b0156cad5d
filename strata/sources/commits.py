"""Commit log of a folder that drops are written to: what readers may trust.

Every write adds one entry ``_commits/<number>.json`` with the folders that it replaced, their files and sizes. The entry is
written under another name and renamed, last of all. A folder counts as committed if its newest entry's
files are all there in full size; so a drop that is being written or replaced, or that a broken job left behind, is not read.
Only names and sizes come to the driver, as any listing does.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

LOG = "_commits"


def _at(spark: SparkSession, path: str):
    """(file system, path) of ``path``, in whatever store Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, path: str) -> dict[str, int]:
    """Size of every file, -1 for a folder, by name; nothing if there is no such folder."""
    fs, p = _at(spark, path)
    return {e.getPath().getName(): -1 if e.isDirectory() else int(e.getLen()) for e in fs.listStatus(p)} if fs.exists(p) else {}


def files(spark: SparkSession, path: str) -> dict[str, int]:
    return {n: size for n, size in entries(spark, path).items() if size >= 0 and not n.startswith((".", "_"))}


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``."""
    fs, to = _at(spark, target)
    if fs.exists(to):
        fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(_at(spark, source)[1], to):
        raise OSError(f"can't put {source} in the place of {target}")


def commit(spark: SparkSession, root: str, folders: list[str]) -> None:
    """Commit the present files of ``folders`` (names under ``root``) as one entry."""
    body = json.dumps({f: files(spark, f"{root}/{f}") for f in folders}).encode()
    fs, part = _at(spark, f"{root}/{LOG}/.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(body))
    out.close()
    while True:
        number = max((int(n.split(".")[0]) for n in entries(spark, f"{root}/{LOG}") if n.endswith(".json")), default=-1) + 1
        target = _at(spark, f"{root}/{LOG}/{number:012d}.json")[1]
        if not fs.exists(target) and fs.rename(part, target):
            return


def committed(spark: SparkSession, root: str) -> dict[str, dict[str, int]] | None:
    """Files and sizes of each folder by its newest entry; None if ``root`` has no log, as folders that others fill."""
    names = sorted(n for n in entries(spark, f"{root}/{LOG}") if n.endswith(".json"))
    if not names:
        return None
    newest: dict[str, dict[str, int]] = {}
    for n in names:
        fs, p = _at(spark, f"{root}/{LOG}/{n}")
        stream = fs.open(p)
        newest |= json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
    return newest


def is_whole(spark: SparkSession, root: str, folder: str, expected: dict[str, int]) -> bool:
    return files(spark, f"{root}/{folder}") == expected
