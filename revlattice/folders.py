"""A folder that driver and executors share, for stages that are written and read again."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    On a local master without that setting it is a temporary folder of the session, the only machine-local one in use;
    a cluster without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='shared-')}"
    return _own[context.applicationId]
