"""The warehouse: sets of tables that change together, by versions.

Layout under a root::

    data/<id>/<table>/part-*.parquet    one folder a publication
    versions/<number>.json              what makes it visible

A publication writes its tables to a fresh folder, as plain Spark jobs, and
then one small file that names the version's day, tables, folders and row
counts, put in place by a rename that replaces nothing.  Readers take the
highest version and read the folders that it names.  So

* a job that dies while it writes leaves the version before as it was;
* readers never see tables of different publications beside each other;
* of two publications at once, one gets the next number and the other the one
  after; a reader that has resolved a version keeps reading it meanwhile.

``expire`` drops old versions and the folders that no version names.  A reader
of an expired version fails like one of a dropped table.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from lodgelens.contracts import CONTRACTS, conform
from lodgelens.sources import storage


class NoVersion(RuntimeError):
    """Nothing was published under a root, or not the version asked for."""


@dataclasses.dataclass(frozen=True)
class Version:
    number: int
    ds: str
    folders: dict[str, str]  # table -> folder
    rows: dict[str, int]


def _file(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/versions/{number:09d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the published versions, oldest first."""
    found = storage.names(spark, f"{root.rstrip('/')}/versions", folders=False)
    return [int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit()]


def resolve(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The given version, or the latest."""
    have = versions(spark, root)
    if not have or (number is not None and number not in have):
        raise NoVersion(f"{root} has no version {'' if number is None else number}")
    number = have[-1] if number is None else number
    said = json.loads(storage.read_text(spark, _file(root, number)))
    base = root.rstrip("/")
    return Version(number, said["ds"], {t: f"{base}/data/{said['id']}/{t}" for t in said["rows"]}, said["rows"])


def read(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of one version (default: the latest), with their contracts' columns and types."""
    v = resolve(spark, root, number)
    return {t: conform(spark.read.parquet(path), CONTRACTS[t], strict=True) if t in CONTRACTS else spark.read.parquet(path)
            for t, path in v.folders.items()}


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, ds) -> Version:
    """Write ``tables`` aside, side by side, then make them the next version.

    Rows are counted while they are written.  The tables are visible all
    together or, if any write fails, not at all.
    """
    base, name = root.rstrip("/"), uuid.uuid4().hex
    seen = {t: Observation(f"publish_{t}_{name}") for t in tables}

    def write(table: str) -> None:
        out = tables[table].observe(seen[table], F.count(F.lit(1)).alias("rows"))
        out.write.parquet(f"{base}/data/{name}/{table}")

    with ThreadPoolExecutor(max_workers=max(len(tables), 1)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write), t) for t in tables]:
            done.result()
    rows = {t: int(o.get["rows"]) for t, o in seen.items()}
    storage.make_folder(spark, f"{base}/versions")
    aside = f"{base}/data/{name}/version.json"
    storage.write_text(spark, aside, json.dumps({"id": name, "ds": str(ds), "rows": rows}))
    while True:
        number = (versions(spark, root) or [0])[-1] + 1
        try:
            storage.move(spark, aside, _file(root, number))
            return resolve(spark, root, number)
        except storage.AlreadyThere:
            continue  # another publication took the number


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Drop all versions but the last ``keep`` and all folders that none of those names; the dropped numbers.

    Folders of publications that are still being written would go as well, so
    this is for when none runs.
    """
    if keep < 1:
        raise ValueError("the last version can't expire")
    base, have = root.rstrip("/"), versions(spark, root)
    stay = {next(iter(v.folders.values()), "/").split("/")[-2] for v in (resolve(spark, root, n) for n in have[-keep:])}
    gone = have[:-keep]
    for n in gone:
        storage.remove(spark, _file(root, n))
    for folder in storage.names(spark, f"{base}/data", folders=True):
        if folder not in stay:
            storage.remove(spark, f"{base}/data/{folder}")
    return gone
