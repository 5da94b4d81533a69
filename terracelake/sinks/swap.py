"""Replacing folders so that readers find the old rows or the new ones, never half of either."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


@contextmanager
def replaced(spark: SparkSession, *paths: str) -> Iterator[list[str]]:
    """Gives one folder to write to for each path; they take the paths' places once all are whole.

    A plain overwrite clears its target before the new rows are there, so a failing task leaves
    nothing. Here the new folders lie beside their targets, under a name that readers and
    ``table_folders`` skip. If the block raises, they go and the targets are as they were. Otherwise
    each target is moved aside, the new folder is moved to its place, and what was moved aside is deleted
    at the end; if a move fails, targets already replaced get their old folders back.

    Moves are renames. On HDFS and local disks a path is missing for the moment between two of them; an
    object store copies instead, which takes longer but never shows a part as the whole.
    """
    hadoop, token = spark._jvm.org.apache.hadoop.fs, uuid.uuid4().hex[:12]
    targets = [hadoop.Path(path) for path in paths]
    files = [target.getFileSystem(spark._jsc.hadoopConfiguration()) for target in targets]
    aside = [hadoop.Path(target.getParent(), f".{target.getName()}.{token}") for target in targets]
    new, old = ([hadoop.Path(folder, name) for folder in aside] for name in ("new", "old"))
    done: list[int] = []
    try:
        yield [folder.toString() for folder in new]
        for i, target in enumerate(targets):
            if files[i].exists(target):
                _move(files[i], target, old[i])
            done.append(i)
            _move(files[i], new[i], target)
    except BaseException:
        for i in reversed(done):
            if files[i].exists(old[i]):
                files[i].delete(targets[i], True)
                _move(files[i], old[i], targets[i])
            elif not files[i].exists(new[i]):  # there was none before
                files[i].delete(targets[i], True)
        raise
    finally:
        for i, path in enumerate(paths):
            # What can't be moved back stays aside, where it can be found.
            if files[i].exists(targets[i]) or not files[i].exists(old[i]):
                files[i].delete(aside[i], True)
            else:
                log.error("the former rows of %s are in %s", path, old[i].toString())
            spark.catalog.refreshByPath(path)


def _move(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source.toString()} can't be moved to {target.toString()}")
