"""Publishing by pointer.

A run's folder holds one immutable folder per attempt and a folder of pointers.
An attempt becomes the run's result by one step, the creation of a small pointer
file whose name has the next version number and the attempt. Nothing is renamed,
overwritten or copied, so this works the same on a file system and on an object
store, and at every moment a reader sees one whole result or, before the first
pointer, none. An attempt that dies leaves a folder that no pointer names.

    {run_dir}/attempt-20240101T000000000000Z-1f0c9a2b/part-*.csv, _MANIFEST/, _PARTS/
    {run_dir}/_CURRENT/000000001~attempt-20240101T000000000000Z-1f0c9a2b
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

# Names sort by time; the underscore hides the pointers from readers of data.
ATTEMPT = "attempt-"
POINTERS = "_CURRENT"
_TIME = "%Y%m%dT%H%M%S%f"
_POINTER = re.compile(r"(\d+)~(.+)")
#: Versions that stay after a publication: readers of the former one go on.
KEPT_VERSIONS = 2


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def put(spark: SparkSession, uri: str, text: str) -> None:
    """A new small file, written by the driver."""
    fs, path = _path(spark, uri)
    out = fs.create(path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def attempt_of(run_dir: str) -> str:
    """A fresh folder for one attempt at the run."""
    now = datetime.now(timezone.utc).strftime(_TIME)
    return f"{run_dir.rstrip('/')}/{ATTEMPT}{now}Z-{uuid.uuid4().hex[:8]}"


def versions(spark: SparkSession, run_dir: str) -> list[tuple[int, str]]:
    """(version, attempt name) of every publication of the run, the oldest first."""
    found = (_POINTER.fullmatch(n) for n in _names(spark, f"{run_dir.rstrip('/')}/{POINTERS}"))
    return sorted((int(m.group(1)), m.group(2)) for m in found if m)


def current(spark: SparkSession, run_dir: str) -> str | None:
    """Folder of the run's result; None before its first publication."""
    found = versions(spark, run_dir)
    return f"{run_dir.rstrip('/')}/{found[-1][1]}" if found else None


def publish(spark: SparkSession, attempt_dir: str) -> None:
    """Make the finished attempt its run's result: one small file is put.

    Two drivers that publish the same run at once get two pointers; the result
    is the higher version, of equal ones the attempt begun last.
    """
    run_dir, _, attempt = attempt_dir.rstrip("/").rpartition("/")
    found = versions(spark, run_dir)
    version = found[-1][0] + 1 if found else 1
    # The name says it all; listings pass over files without content.
    put(spark, f"{run_dir}/{POINTERS}/{version:09d}~{attempt}", attempt + "\n")


def retire(spark: SparkSession, run_dir: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Delete the results of all but the last ``keep`` versions, pointers first;
    returns their attempts."""
    run_dir, gone = run_dir.rstrip("/"), []
    found = versions(spark, run_dir)
    for version, attempt in found[: max(0, len(found) - keep)]:
        discard(spark, f"{run_dir}/{POINTERS}/{version:09d}~{attempt}")
        discard(spark, f"{run_dir}/{attempt}")
        gone.append(attempt)
    return gone


def discard(spark: SparkSession, folder: str) -> None:
    fs, path = _path(spark, folder)
    fs.delete(path, True)


def attempts(spark: SparkSession, runs: str) -> list[tuple[str, str, str]]:
    """(job folder, run id, attempt) of every attempt folder under the glob
    ``runs``, by listing alone."""
    fs, path = _path(spark, f"{runs.rstrip('/')}/{ATTEMPT}*")
    found = fs.globStatus(path) or []
    return sorted(tuple(str(s.getPath()).rsplit("/", 3)[1:]) for s in found)


def begun(attempt: str) -> datetime:
    return datetime.strptime(attempt[len(ATTEMPT) :].split("Z")[0], _TIME).replace(tzinfo=timezone.utc)


def sweep(spark: SparkSession, run_dir: str, idle: timedelta) -> list[str]:
    """Delete attempts of the run that were begun more than ``idle`` ago and
    that neither a pointer nor a manifest names (killed ones); returns them."""
    run_dir = run_dir.rstrip("/")
    published = {attempt for _, attempt in versions(spark, run_dir)}
    old = datetime.now(timezone.utc) - idle
    gone = []
    for name in _names(spark, run_dir):
        if name.startswith(ATTEMPT) and name not in published and begun(name) < old:
            discard(spark, f"{run_dir}/{name}")
            gone.append(name)
    return gone
