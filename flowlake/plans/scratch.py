"""Shared scratch locations.

Intermediate files (landed snapshots, written silver/gold tables) go under
the folder the cluster names in ``spark.checkpoint.dir`` -- a shared file
system every executor can reach. Only a local session that names none (tests
and trials, where driver and executors are one process) gets a temporary
folder; on a cluster a missing setting is an error, because executors would
write where nobody else can read. Scratch folders are deleted when the
driver ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from ..sources.paths import delete_at_exit

_LOCAL_ROOTS: dict[str, str] = {}


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    d = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = _LOCAL_ROOTS.get(context.applicationId)
        if d is None:
            d = _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="flowlake-scratch-")
    return d.rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root."""
    path = f"{shared_root(spark)}/flowlake/{name}-{uuid.uuid4().hex[:12]}"
    delete_at_exit(spark, path)
    return path
