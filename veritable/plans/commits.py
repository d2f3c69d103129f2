"""Storing the results of a run once, however often the run is repeated.

A run is known by its dataset and run id. Its rows are written into a staging folder
first, which readers skip (its name begins with an underscore), and then moved into the
table by one rename per partition: a run has one date, so by default it is one rename in
all. The files carry a digest of the run in their names, by which a repeated run finds
and replaces what it stored before, in whatever partition that is. A job that dies

* while it writes leaves a staging folder and nothing in the table,
* after the rename has stored all its rows,
* between removing its former files and the rename has stored none,

and its repetition ends with the rows of one run in each case. Readers may miss a run
for the moment in which it is replaced; they never see it twice.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from veritable.plans.compaction import STAGING, take_out_run
from veritable.sources.files import Folder, join
from veritable.sources.tables import check_format, write_table


def run_name(dataset: str, run_id: str) -> str:
    """The beginning of the names of a run's files."""
    digest = hashlib.sha256(f"{len(dataset)}:{dataset}{run_id}".encode()).hexdigest()
    return f"run-{digest[:32]}"


def commit_run(
    results: DataFrame,
    path: str,
    dataset: str,
    run_id: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    num_files: int = 1,
) -> None:
    """Add the rows of one run to the table at ``path``, in place of what the run stored before."""
    fmt = check_format(fmt)
    name = run_name(dataset, run_id)
    table = Folder(results.sparkSession, path)
    attempt = f"{name}-{uuid.uuid4().hex}"
    write_table(results, join(path, STAGING, attempt), fmt, "error", partition_by, num_files)
    take_out_run(results.sparkSession, path, fmt, name, dataset, run_id, partition_by)
    _publish(table, name, attempt, len(partition_by))


def _publish(table: Folder, name: str, attempt: str, depth: int) -> None:
    partitions = "*/" * depth
    staged = f"{STAGING}/{attempt}"
    fresh = table.files(f"{staged}/{partitions}part-*")
    # A name of its own: the former one may be among those that a compaction has replaced.
    own = f"{name}-{attempt[-8:]}"
    for former in table.files(f"{partitions}{name}-*"):
        if not former.startswith(STAGING):
            table.remove(former)
    for number, file in enumerate(fresh):
        folder, _, leaf = file.removeprefix(f"{staged}/").rpartition("/")
        _, dot, endings = leaf.partition(".")
        table.move(file, f"{folder}/{own}-{number}{dot}{endings}".lstrip("/"))
    # What this and earlier attempts at the run have left behind.
    for left in table.files(f"{STAGING}/{name}-*"):
        table.remove(left)
    if not table.files(f"{STAGING}/*"):
        table.remove(STAGING)
