"""Session helpers: a local session for tests and benches, and checks on a given session."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tidelane", **conf: str) -> SparkSession:
    """A local session. A cluster job brings its own session and never calls this."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Zone-less times are compared as microseconds through the session zone, so it must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is made only where a single-process session names none, which is the case in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        named = tempfile.mkdtemp(prefix="tidelane-")
        spark.sparkContext.setCheckpointDir(named)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


_made: list[str] = []


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder. What is written there stays until :func:`clear_shared`: results may read it later."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def shared_mark() -> int:
    """Where in the list of shared paths this process stands now, for :func:`clear_shared`."""
    return len(_made)


def clear_shared(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables this process wrote to the shared folder (since a :func:`shared_mark`), once the
    results that read them are written or collected. Returns how many there were."""
    jvm, gone = spark.sparkContext._jvm, 0
    for path in _made[since:]:
        place = jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        gone += bool(files.delete(place, True))
    del _made[since:]
    return gone
