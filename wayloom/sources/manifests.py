"""Versions of a stored table: written aside, described by a manifest, and current from then on.

A table's folder holds its versions under ``_versions`` and one small manifest for each finished version
under ``_manifests``. Nothing is ever written over: a version's files are all there before its manifest
appears, as one new object, and the newest manifest names the current version. So a reader keeps the files
it began with, a writer that dies leaves the version before it current, and no rename is needed, which
object stores lack. Superseded versions go once newer ones are finished, all but the last few.

A manifest knows its version by a listing of its files: how many, how large, and a digest over their names
and sizes. Listings are taken and added up by Spark, so that a table of a million files is no list on the
driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS, MANIFESTS = "_versions", "_manifests"
#: Finished versions that are kept: the current one and the one before, which readers may still hold.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Manifest:
    """One finished version of a table.

    ``settings`` is what the version was made from, ``parents`` which versions of other tables,
    ``report`` what was observed of its rows while they were written.
    """

    path: str
    version: str
    settings: str
    files: int
    bytes: int
    digest: str
    rows: int
    parents: list[str] = field(default_factory=list)
    report: dict[str, Any] = field(default_factory=dict)

    @property
    def location(self) -> str:
        return f"{self.path}/{VERSIONS}/{self.version}"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes and modified of all visible files below a path; their contents are not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def digest(files: DataFrame, *identity: str) -> tuple[int, int, str]:
    """How many files, how many bytes, and a digest of the named columns that no order of files changes."""
    named = F.xxhash64(*identity)
    row = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor(named), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(named.cast("decimal(38,0)")), F.lit(0)).alias("added"),
    ).first()
    halves = (row["mixed"], int(row["added"]))
    return row["files"], row["bytes"], "".join(f"{half & (2**64 - 1):016x}" for half in halves)


def input_digest(spark: SparkSession, path: str) -> str:
    """Of the input's files: their names, sizes and times. A changed, added or removed file changes it."""
    files, size, mixed = digest(listing(spark, path), "file", "bytes", "modified")
    return f"{files} {size} {mixed}"


def _own_digest(spark: SparkSession, location: str) -> tuple[int, int, str]:
    files = listing(spark, location)
    return digest(files.withColumn("file", F.element_at(F.split("file", "/"), -1)), "file", "bytes")


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def _finished(spark: SparkSession, path: str) -> list[str]:
    """Names of finished versions, the newest last."""
    fs, where = _file_system(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))


def _manifest(spark: SparkSession, path: str, version: str) -> Manifest | None:
    try:
        text = "\n".join(r["value"] for r in spark.read.text(f"{path}/{MANIFESTS}/{version}.json").collect())
        return Manifest(path=path, version=version, **json.loads(text))
    except (AnalysisException, ValueError, TypeError):
        return None  # not whole yet, or of another kind


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest finished version, if there is one."""
    for version in reversed(_finished(spark, path)):
        if found := _manifest(spark, path, version):
            return found
    return None


def location(spark: SparkSession, path: str) -> str:
    """Folder of the current version, for any reader of Parquet; raises if no version is finished."""
    found = current(spark, path)
    if not found:
        raise FileNotFoundError(f"no finished version in {path}")
    return found.location


def is_whole(spark: SparkSession, manifest: Manifest | None, settings: str | None = None) -> bool:
    """The version was made from these settings, and its files are all there."""
    if manifest is None or (settings is not None and manifest.settings != settings):
        return False
    try:
        return _own_digest(spark, manifest.location) == (manifest.files, manifest.bytes, manifest.digest)
    except AnalysisException:
        return False


def add_version(
    spark: SparkSession,
    path: str,
    write: Callable[[str], dict[str, Any] | None],
    settings: str = "",
    parents: list[str] | None = None,
    check: Callable[[], None] | None = None,
    keep: int = KEPT_VERSIONS,
) -> Manifest:
    """Have ``write`` fill a new version's folder, then make the version current.

    ``write`` may return what it observed, the number of ``rows`` with it; otherwise rows are counted from
    the files' footers. ``check`` runs before the version is current and may refuse it by raising.
    """
    past = _finished(spark, path)
    number = int(past[-1].partition("-")[0]) + 1 if past else 1
    version = f"{number:010d}-{uuid.uuid4().hex[:12]}"
    folder = f"{path}/{VERSIONS}/{version}"
    report = write(folder) or {}
    if check:
        check()
    rows = report["rows"] if "rows" in report else spark.read.parquet(folder).count()
    files, size, mixed = _own_digest(spark, folder)
    made = Manifest(path, version, settings, files, size, mixed, rows, parents or [], report)
    known = {k: v for k, v in asdict(made).items() if k not in ("path", "version")}
    fs, where = _file_system(spark, f"{path}/{MANIFESTS}/{version}.json")
    out = fs.create(where, False)
    try:
        out.write(bytearray(json.dumps(known, sort_keys=True).encode()))
    finally:
        out.close()
    forget(spark, path, keep)
    return made


def forget(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> None:
    """Remove all finished versions but the newest ``keep``; a manifest goes before its files.

    A folder without a manifest is left alone: another writer may be at work in it.
    """
    for version in _finished(spark, path)[: -max(1, keep)]:
        for name in (f"{MANIFESTS}/{version}.json", f"{VERSIONS}/{version}"):
            fs, where = _file_system(spark, f"{path}/{name}")
            fs.delete(where, True)
