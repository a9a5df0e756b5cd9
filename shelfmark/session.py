"""Session helpers: the shared work folder and shipping this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark import Broadcast
from pyspark.sql import SparkSession

_shipped: set[str] = set()
_shared: ContextVar[list[Broadcast] | None] = ContextVar("shared", default=None)


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and streaming state.

    The cluster names it in ``spark.checkpoint.dir``; without that, it is a folder
    of the warehouse, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A folder name under :func:`work_root` that no other run uses."""
    return f"{work_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable on the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_root(spark))


def share(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast a value whose size the caller has checked."""
    block = spark.sparkContext.broadcast(value)
    held = _shared.get()
    if held is not None:
        held.append(block)
    return block


@contextmanager
def released() -> Iterator[None]:
    """Free what was shared inside, once the results have been written.

    A job that goes on for long needs this; others free all at the end.
    """
    token = _shared.set([])
    try:
        yield
    finally:
        for block in _shared.get() or []:
            block.destroy()
        _shared.reset(token)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfmark-ship-"), "shelfmark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
