"""Tables that are replaced by writing the next version beside the current one.

``<path>/version=<n>`` holds one whole version. It counts once its marker is written, which is
the last step; readers take the highest that counts. A failed write leaves the
current version untouched, and its remains are removed by the next write that succeeds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from termloom.plans.staging import file_system

MARKER = "_COMPLETE"
_NAME = re.compile(r"version=(\d+)$")


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version numbers under ``path``, and whether each counts."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = _NAME.match(status.getPath().getName())
        if name:
            _, marker = file_system(spark, f"{path}/{name[0]}/{MARKER}")
            found[int(name[1])] = fs.exists(marker)
    return found


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts, or None if there is none."""
    complete = [n for n, counts in _versions(spark, path).items() if counts]
    return f"{path}/version={max(complete)}" if complete else None


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """The folder to write the next version into; it counts when the block ends without error."""
    before = _versions(spark, path)
    folder = f"{path}/version={max(before, default=-1) + 1}"
    yield folder
    fs, marker = file_system(spark, f"{folder}/{MARKER}")
    fs.create(marker, True).close()
    for number in before:
        _, old = file_system(spark, f"{path}/version={number}")
        fs.delete(old, True)
