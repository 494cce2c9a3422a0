"""Run manifests: a set of table versions that becomes visible in one step.

A manifest is one small JSON file below ``{root}/manifests`` that names the
version path of every table of a run. It is written under a temporary name and
renamed when complete, and it is never changed afterwards. A reader
opens the newest manifest once and resolves all tables from it, so
between any two steps of a publish it sees the set before or the set after,
never a mixture, also from another application: no catalog is involved.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from arrivals_mart.contracts import BY_NAME, Contract
from arrivals_mart.sinks.tables import hadoop_path, read_table

FOLDER = "manifests"
_NAME = re.compile(r"m(\d{13,})-[0-9a-f]{8}\.json")


@dataclass(frozen=True)
class Manifest:
    """``paths`` by table name; ``name`` is the file's, and sorts by time."""

    name: str
    paths: dict[str, str]


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/{FOLDER}"


def publish_manifest(spark: SparkSession, root: str, paths: Mapping[str, str]) -> Manifest:
    """Make ``paths`` (version path by table) the current set of ``root``.

    The rename of the finished file is the only step that readers can see. If
    two publishers take part, the later name is the current one. A publisher whose clock is behind
    still follows the newest manifest there is."""
    listed = manifests(spark, root)
    now = int(time.time() * 1000)
    if listed:
        now = max(now, int(_NAME.fullmatch(listed[-1])[1]) + 1)
    name = f"m{now:013d}-{uuid.uuid4().hex[:8]}.json"
    fs, temporary = hadoop_path(spark, f"{_folder(root)}/.{name}")
    _, final = hadoop_path(spark, f"{_folder(root)}/{name}")
    out = fs.create(temporary, False)
    try:
        out.write(json.dumps({"tables": dict(paths)}, sort_keys=True).encode())
    finally:
        out.close()
    if not fs.rename(temporary, final):
        raise OSError(f"{_folder(root)}/{name}: the manifest could not be renamed")
    return Manifest(name, dict(paths))


def manifests(spark: SparkSession, root: str) -> list[str]:
    """Names of all manifests of ``root``, oldest first."""
    fs, folder = hadoop_path(spark, _folder(root))
    if not fs.exists(folder):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    return sorted(n for n in names if _NAME.fullmatch(n))


def read_manifest(spark: SparkSession, root: str, name: str | None = None) -> Manifest:
    """The manifest ``name`` of ``root``, by default the newest."""
    if name is None:
        names = manifests(spark, root)
        if not names:
            raise FileNotFoundError(f"{root}: nothing is published")
        name = names[-1]
    text = spark.read.option("wholetext", True).text(f"{_folder(root)}/{name}").first()[0]
    return Manifest(name, json.loads(text)["tables"])


def open_set(
    spark: SparkSession, root: str, name: str | None = None, contracts: Mapping[str, Contract] = BY_NAME
) -> dict[str, DataFrame]:
    """All tables of one manifest, as lazy frames of one and the same run."""
    found = read_manifest(spark, root, name)
    return {table: read_table(spark, path, contracts.get(table)) for table, path in found.paths.items()}


def expire_manifests(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` manifests; returns the version paths
    that no manifest names any more. The paths are not deleted here."""
    if keep < 1:
        raise ValueError("at least one manifest stays")
    names = manifests(spark, root)
    kept = {p for n in names[-keep:] for p in read_manifest(spark, root, n).paths.values()}
    gone: Iterable[str] = []
    for n in names[:-keep]:
        gone = [*gone, *(p for p in read_manifest(spark, root, n).paths.values() if p not in kept)]
        fs, path = hadoop_path(spark, f"{_folder(root)}/{n}")
        fs.delete(path, False)
    return sorted(set(gone))
