"""One file a partition instead of one a run, without readers seeing a row twice or not at all.

A compacted history has a manifest: a small table that names the compacted files that
count, with the runs in each, and the files that they replace. Readers
(``stored_results`` and what builds on it) take the files of the folder, without those
replaced and without compacted ones that the newest manifest does not name. So a
compaction takes effect by one rename, that of its manifest; killed before, it has
changed nothing that is read. Replaced files are removed by the next compaction, until
when a reader that started earlier may still need them.

A run that is repeated after it was compacted is taken out of its compacted file first,
by a manifest as well. One compaction or repetition at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritable.plans.results import RESULT_SCHEMA
from veritable.sources.files import Folder, join
from veritable.sources.tables import check_format, read_table, write_table

MANIFESTS, STAGING = "_manifest", "_staging"
_COMPACTED = "compact-"
_ENTRIES = "file string, counts boolean, runs array<string>, depth int"
#: Read-back options that keep a CSV history equal to what was written: empty
#: text stays apart from NULL, and a description may span lines.
CSV_OPTIONS = {"nullValue": "\u0000", "multiLine": "true"}


@dataclass
class Manifest:
    """The newest manifest: compacted files that count, with their runs, and files replaced."""

    version: int = 0
    depth: int = 0
    compacted: dict[str, list[str]] = field(default_factory=dict)
    replaced: set[str] = field(default_factory=set)

    def live(self, files: Sequence[str]) -> list[str]:
        """Those of ``files`` that are read."""
        return [
            name
            for name in files
            if name not in self.replaced and (name in self.compacted or not name.rpartition("/")[2].startswith(_COMPACTED))
        ]


def _listed(folder: Folder, depth: int) -> list[str]:
    found = folder.files("*/" * depth + "*")
    return [name for name in found if not name.startswith(("_", ".")) and not name.rpartition("/")[2].startswith(("_", "."))]


def read_manifest(folder: Folder) -> Manifest | None:
    """The newest manifest of a history, None if it was never compacted."""
    names = folder.files(f"{MANIFESTS}/version-*")
    if not names:
        return None
    rows = folder.spark.read.schema(_ENTRIES).parquet(join(folder.path, names[-1])).collect()
    found = Manifest(int(names[-1].rpartition("-")[2]), max((row["depth"] for row in rows), default=0))
    for row in rows:
        if row["file"] is not None and row["counts"]:
            found.compacted[row["file"]] = list(row["runs"])
        elif row["file"] is not None:
            found.replaced.add(row["file"])
    return found


def _publish(folder: Folder, manifest: Manifest) -> None:
    """Make a manifest the newest one, by one rename."""
    rows = [(None, False, [], manifest.depth)]
    rows += [(name, True, runs, manifest.depth) for name, runs in manifest.compacted.items()]
    rows += [(name, False, [], manifest.depth) for name in sorted(manifest.replaced)]
    staged = f"{STAGING}/manifest-{uuid.uuid4().hex}"
    folder.spark.createDataFrame(rows, _ENTRIES).coalesce(1).write.parquet(join(folder.path, staged))
    folder.move(staged, f"{MANIFESTS}/version-{manifest.version + 1:08d}")
    for old in folder.files(f"{MANIFESTS}/version-*")[:-2]:
        folder.remove(old)


def read_files(spark: SparkSession, path: str, fmt: str, names: Sequence[str]) -> DataFrame:
    """The results in some files of a history, partition columns included."""
    if not names:
        return spark.createDataFrame([], RESULT_SCHEMA)
    options = CSV_OPTIONS if fmt == "csv" else {}
    # Names may hold what a glob pattern would take for its own.
    paths = [join(path, name) for name in names]
    return read_table(spark, paths, fmt, RESULT_SCHEMA, basePath=path, **options).select(*RESULT_SCHEMA.fieldNames())


def _rewritten(rows: DataFrame, folder: Folder, fmt: str, partition_by: Sequence[str]) -> list[str]:
    """``rows`` as one compacted file a partition, which does not count yet; the files' names."""
    staged = f"{STAGING}/compact-{uuid.uuid4().hex}"
    dealt = rows.repartition(*partition_by) if partition_by else rows.coalesce(1)
    write_table(dealt, join(folder.path, staged), fmt, "error", partition_by)
    made = []
    for name in folder.files(f"{staged}/{'*/' * len(partition_by)}part-*"):
        place, _, leaf = name.removeprefix(f"{staged}/").rpartition("/")
        target = f"{place}/{_COMPACTED}{uuid.uuid4().hex}.{leaf.partition('.')[2]}".lstrip("/")
        folder.move(name, target)
        made.append(target)
    folder.remove(staged)
    return made


def live_files(folder: Folder, manifest: Manifest) -> list[str]:
    """The files of a history that are read."""
    return manifest.live(_listed(folder, manifest.depth))


def _run_of(name: str) -> list[str]:
    leaf = name.rpartition("/")[2]
    return ["-".join(leaf.split("-")[:2])] if leaf.startswith("run-") else []


def compact_history(
    spark: SparkSession, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("run_date",), before: str | None = None
) -> int:
    """Turn the files of each partition into one, and return how many files were replaced.

    ``partition_by`` is what the history was written with. ``before`` leaves partitions alone
    whose first column is not below it, such as today's date. All partitions are rewritten by
    one job; one that is a single file already is not read.
    """
    fmt = check_format(fmt)
    folder = Folder(spark, path)
    if read_manifest(folder) is None:
        _publish(folder, Manifest(depth=len(partition_by)))  # from here on, compacted files have to be named
    manifest = read_manifest(folder)
    for name in manifest.replaced:
        folder.remove(name)
    manifest.replaced, manifest.depth = set(), len(partition_by)
    by_place: dict[str, list[str]] = {}
    for name in manifest.live(_listed(folder, len(partition_by))):
        by_place.setdefault(name.rpartition("/")[0], []).append(name)
    several = {
        place: names
        for place, names in by_place.items()
        if len(names) > 1 and (before is None or place.split("/")[0].partition("=")[2] < before)
    }
    old = [name for names in several.values() for name in names]
    if old:
        for name in _rewritten(read_files(spark, path, fmt, old), folder, fmt, partition_by):
            held = several.get(name.rpartition("/")[0], [])
            manifest.compacted[name] = [run for one in held for run in (manifest.compacted.get(one) or _run_of(one))]
    manifest.replaced = set(old)
    manifest.compacted = {name: runs for name, runs in manifest.compacted.items() if name not in manifest.replaced}
    _publish(folder, manifest)
    return len(old)


def take_out_run(spark: SparkSession, path: str, fmt: str, name: str, dataset: str, run_id: str, partition_by: Sequence[str]) -> None:
    """Remove a run from the compacted files that hold it, if any does; it is known by ``name`` there."""
    folder = Folder(spark, path)
    manifest = read_manifest(folder)
    held = [file for file, runs in manifest.compacted.items() if name in runs] if manifest else []
    if not held:
        return
    rows = read_files(spark, path, fmt, held).where((F.col("run_id") != run_id) | (F.col("dataset") != dataset))
    others = {file.rpartition("/")[0]: [run for run in manifest.compacted[file] if run != name] for file in held}
    made = _rewritten(rows, folder, fmt, partition_by)
    manifest.compacted = {file: runs for file, runs in manifest.compacted.items() if file not in held}
    manifest.compacted |= {file: others.get(file.rpartition("/")[0], []) for file in made}
    manifest.replaced |= set(held)
    _publish(folder, manifest)
