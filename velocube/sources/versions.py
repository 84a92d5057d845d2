"""Versioned Parquet tables: folders that are never rewritten, and a manifest for each version.

    <root>/data/<id>/_part=<value>/*.parquet     rows of one commit, by partition value
    <root>/_versions/00000003.json               which folders make up version 3

A commit writes its rows below a folder of its own and then, last, the next manifest under a name that must not exist yet
(written beside it and renamed, which fails where another commit came first).  A job that dies half way leaves a folder that no
manifest names; readers are bound to the version they opened, whole partitions at a time, and older versions stay
readable.  A manifest has one line a partition, so its size follows the months, not the files.  A plain Parquet folder
without manifests counts as version 0.
"""
from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_PART, _NULL = "_part", "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another commit made the same version first."""


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path  # noqa: SLF001


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def renamed(spark: SparkSession, old: str, new: str) -> None:
    """Move a file (the folder it goes to is made)."""
    fs, target = _fs(spark, new)
    fs.mkdirs(target.getParent())
    if not fs.rename(_fs(spark, old)[1], target):
        raise OSError(f"{old} could not be renamed to {new}")


def history(spark: SparkSession, root: str) -> list[int]:
    """The versions of a table, oldest first."""
    return [int(m[1]) for name in listed(spark, f"{root}/_versions") if (m := re.fullmatch(r"(\d{8})\.json", name))]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict]:
    """(version, {partition value: folder}) of a version, the newest by default; (0, {}) where there is none."""
    versions = history(spark, root)
    if version is None and not versions:
        return 0, {}
    version = versions[-1] if version is None else version
    if version not in versions:
        raise ValueError(f"{root} has no version {version}")
    text = spark.read.text(f"{root}/_versions/{version:08d}.json", wholetext=True).first()[0]
    return version, {e["value"]: e["folder"] for e in json.loads(text)["partitions"]}


def commit(spark: SparkSession, root: str, version: int, folders: dict) -> None:
    """Publish ``version``; raises Conflict if it exists."""
    fs, folder = _fs(spark, f"{root}/_versions")
    fs.mkdirs(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
    staged, final = path(folder, f"_{uuid.uuid4().hex}"), path(folder, f"{version:08d}.json")
    body = json.dumps({"version": version, "partitions": [{"value": v, "folder": f} for v, f in sorted(folders.items(), key=str)]})
    out = fs.create(staged, False)
    out.write(bytearray(body.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        raise Conflict(f"version {version} of {root} exists")


def read(spark: SparkSession, root: str, version: int | None = None, values: list | None = None) -> DataFrame | None:
    """A version of the table (only the partitions ``values``, if given); None where nothing is there.

    Any failure but a missing table (a damaged file, no permission) raises.
    """
    number, folders = manifest(spark, root, version)
    if number == 0:
        try:
            return spark.read.parquet(root)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
    wanted = [f for v, f in folders.items() if values is None or v in values]
    if not wanted:  # the schema of the table, no rows
        return spark.read.parquet(f"{root}/{next(iter(folders.values()))}").limit(0) if folders else None
    return spark.read.parquet(*[f"{root}/{f}" for f in wanted])


def replace(spark: SparkSession, root: str, rows: DataFrame, partition_col: str | None, base: int, keep: dict) -> DataFrame:
    """Commit version ``base`` + 1: ``rows``, whole partitions of them, and the folders ``keep`` of the version before."""
    name = f"data/{uuid.uuid4().hex}"
    value = F.col(partition_col).cast("string") if partition_col else F.lit(None).cast("string")
    parted = rows.withColumn(_PART, value)
    parted = parted.hint("rebalance", _PART) if partition_col else parted  # a few files a partition, and large ones split
    parted.write.partitionBy(_PART).parquet(f"{root}/{name}")
    new = {}
    for entry in listed(spark, f"{root}/{name}"):
        if entry.startswith(f"{_PART}="):
            found = unquote(entry[len(_PART) + 1:])
            new[None if found == _NULL else found] = f"{name}/{entry}"
    commit(spark, root, base + 1, {**keep, **new})
    return read(spark, root, base + 1)
