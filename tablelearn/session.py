"""Session helpers: one place for the settings every job relies on.

On a cluster the session comes from the platform; ``configure`` only fills in
what is unset.  ``scratch_dir`` is the shared folder used to cut lineage
(``spark.checkpoint.dir``); a machine-local folder is only created when the
setting is missing, which happens in local tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tablelearn", driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    builder = (builder.config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the master is local (tests, bench) a fresh folder under the system temp dir
    is used; on a cluster an unset setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local "
                               "folder cannot hold checkpoints on a cluster")
        current = tempfile.mkdtemp(prefix="tablelearn-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is written there goes when the application ends."""
    if not _made:
        atexit.register(remove_scratch)
    _made.append(scratch_dir(spark).rstrip("/") + "/" + name + "-" + os.urandom(6).hex())
    return _made[-1]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is planned and run within deletes its shuffle files at its end, not when the driver collects its garbage."""
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def remove_scratch() -> None:
    """Deletes all that this application has written to scratch paths (results that read them end with it)."""
    spark = SparkSession.getActiveSession()
    if spark is None:  # the session was stopped before; its platform cleans the folder
        return
    conf = spark._jsc.hadoopConfiguration()
    for path in _made:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    _made.clear()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors (once per Spark application), wherever the driver imported it from."""
    sc = spark.sparkContext
    if getattr(sc, "_tablelearn_sent", None) is None:
        root = Path(__file__).resolve().parents[1]
        sc._tablelearn_sent = shutil.make_archive(f"{tempfile.mkdtemp()}/tablelearn", "zip", root, "tablelearn")
        sc.addPyFile(sc._tablelearn_sent)
    return spark


def shuffle_partitions(spark: SparkSession, default: int = 200) -> int:
    """The session's shuffle partition count (a non-numeric setting gives ``default``)."""
    value = spark.conf.get("spark.sql.shuffle.partitions", str(default))
    try:
        return max(1, int(value))
    except (TypeError, ValueError):
        return default
