"""Runtime settings every job relies on; all can be changed on a live session."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    # Coalesce small shuffle partitions, split skewed ones, switch join strategy at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs the next step a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Month arithmetic passes through midnight; UTC has one every day.
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside, _before = Lock(), {}, {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files once they end; else those stay until the driver collects its garbage.

    For a plan of several steps, each of which runs once.  A step that is run again would have to shuffle again.
    """
    session = id(spark._jsparkSession), spark.sparkContext.applicationId
    with _lock:
        if not _inside.get(session):
            _before[session] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _inside[session] = _inside.get(session, 0) + 1
    try:
        yield
    finally:
        with _lock:
            _inside[session] -= 1
            if not _inside[session]:
                spark.conf.set(_CLEANUP, _before.pop(session))
                del _inside[session]
