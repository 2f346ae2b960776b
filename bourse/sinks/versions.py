"""Versioned tables: rows are written to a folder of their own, and a manifest
row, written last, names the folders that are current.

    {path}/_versions/{number}-{id}/...   rows; written once, never changed
    {path}/_manifest/*.json              a row for each version

A version is a list of parts (a name, such as a year or an ingest, and its
folder). A new version may keep parts of the one before it, so replacing one
year writes one year. A write that fails or is killed leaves no manifest
row: readers go on with the version before, whose files nobody touches.
Both names begin with an underscore, so a reader that doesn't know of
versions finds no files instead of superseded rows.

One writer at a time: ``publish`` refuses if another version has appeared
since its base was read, but two that publish in the same moment are not
kept apart. Old versions stay until the folder's owner removes them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, parts array<struct<name:string,folder:string>>, notes string"


class VersionConflict(RuntimeError):
    """Another version was published since the base of this one was read."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[tuple[str, str], ...]
    notes: dict = field(default_factory=dict)


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest published version, or None if ``path`` isn't versioned."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{path.rstrip('/')}/_manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = rows.filter("version IS NOT NULL").orderBy(F.desc("version")).first()
    if last is None:
        return None
    return Version(last.version, tuple((p.name, p.folder) for p in last.parts), json.loads(last.notes))


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of the current version; a path that isn't versioned is its
    own only folder."""
    version = current(spark, path)
    return [path] if version is None else [folder for _, folder in version.parts]


def new_folder(path: str, base: Version | None) -> str:
    """A folder for rows of the version that follows ``base``."""
    return f"{path.rstrip('/')}/_versions/{(base.number if base else 0) + 1:06d}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, path: str, base: Version | None, parts, notes: dict | None = None) -> Version:
    """Make ``parts`` (name, folder) the current version, after ``base``."""
    found = current(spark, path)
    if (found.number if found else 0) != (base.number if base else 0):
        raise VersionConflict(f"{path} has version {found.number if found else 0}, not {base.number if base else 0}")
    version = Version((base.number if base else 0) + 1, tuple(parts), notes or {})
    listed = [F.struct(F.lit(n).alias("name"), F.lit(f).alias("folder")) for n, f in version.parts]
    none = F.array().cast("array<struct<name:string,folder:string>>")
    spark.range(1).coalesce(1).select(F.lit(version.number).cast("long").alias("version"), (F.array(*listed) if listed else none).alias("parts"),
                                      F.lit(json.dumps(version.notes)).alias("notes")) \
        .write.mode("append").json(f"{path.rstrip('/')}/_manifest")
    return version
