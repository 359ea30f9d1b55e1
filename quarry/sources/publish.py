"""Tables that are published whole or not at all.

A version's files go to a folder of their own; one small manifest, written last, makes it the current version. Readers
follow the newest manifest that is complete, so a writer that dies at any point leaves the version before it
readable, and files of a failed attempt are never seen. Two writers of the same version: the manifest of one
exists already and the other fails. Everything goes through Hadoop's file systems, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_MANIFESTS, _DATA = "_manifests", "data"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change in ms) of what lies in a folder; none if there is no folder."""
    fs, p = _fs(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)] if fs.exists(p) else []


def versions(spark: SparkSession, base: str) -> list[dict]:
    """Manifests of the complete versions, oldest first."""
    out = []
    for name, _ in sorted(_children(spark, f"{base}/{_MANIFESTS}")):
        if not name.endswith(".json"):
            continue
        text = "".join(r.value for r in spark.read.text(f"{base}/{_MANIFESTS}/{name}", wholetext=True).collect())
        try:
            out.append(json.loads(text))
        except json.JSONDecodeError:  # its writer died while it wrote the manifest
            continue
    return out


def publish(df: DataFrame, base: str, expected: int | None = None, options: dict | None = None) -> int:
    """Write ``df`` as the next version of the Parquet table at ``base``; returns the version number.

    ``expected`` is the version that ``df`` was made from (0: none yet): publishing fails if another one has been
    published since, so an update from an older state is never lost silently.
    """
    spark = df.sparkSession
    known = versions(spark, base)
    current = known[-1]["version"] if known else 0
    if expected is not None and expected != current:
        raise ValueError(f"version {current} of {base} has been published since version {expected}")
    # numbers of broken manifests are not used again
    taken = [int(n.split(".")[0]) for n, _ in _children(spark, f"{base}/{_MANIFESTS}") if n.endswith(".json")]
    number = max([current, *taken]) + 1
    folder = f"{_DATA}/v{number:010d}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(**(options or {})).parquet(f"{base}/{folder}")
    _commit(spark, base, {"version": number, "data": folder, "published": int(time.time() * 1000)})
    return number


def _commit(spark: SparkSession, base: str, manifest: dict) -> None:
    fs, p = _fs(spark, f"{base}/{_MANIFESTS}/{manifest['version']:010d}.json")
    out = fs.create(p, False)  # fails if it exists
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()


def published(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The newest version (or a stated one) of the table at ``base``."""
    known = [m for m in versions(spark, base) if version in (None, m["version"])]
    if not known:
        raise FileNotFoundError(f"no such version is published at {base}")
    return spark.read.parquet(f"{base}/{known[-1]['data']}")


def current_version(spark: SparkSession, base: str) -> int:
    """Number of the newest version, 0 if nothing has been published."""
    known = versions(spark, base)
    return known[-1]["version"] if known else 0


def remove_old(spark: SparkSession, base: str, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
    """Delete data of versions beyond the newest ``keep`` and of failed attempts, if older than the stated age (a
    running writer's files are younger). Manifests of deleted versions go first, so no reader is sent to missing files. Returns the folders."""
    known = versions(spark, base)
    stay = {m["data"].split("/")[-1] for m in known[-keep:]} if keep else set()
    before = time.time() * 1000 - older_than_hours * 3_600_000
    gone = []
    for name, changed in _children(spark, f"{base}/{_DATA}"):
        if name in stay or changed > before:
            continue
        for m in known:
            if m["data"].endswith(name):
                fs, p = _fs(spark, f"{base}/{_MANIFESTS}/{m['version']:010d}.json")
                fs.delete(p, False)
        fs, p = _fs(spark, f"{base}/{_DATA}/{name}")
        fs.delete(p, True)
        gone.append(name)
    return gone
