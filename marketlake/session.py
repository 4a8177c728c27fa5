"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from marketlake import files

_LOCAL_DIRS: dict[str, str] = {}
_SCRATCH: set[str] = set()


def local_session(cores: int | str = 8, app: str = "marketlake", memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark. A cluster brings its own."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own; a cluster
    without it is refused, since a driver-local folder would be invisible to executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="marketlake-")
    return _LOCAL_DIRS[app]


def _scratch(spark: SparkSession) -> str:
    """This application's folder under the shared one; it goes when the application ends."""
    folder = f"{shared_dir(spark)}/marketlake/{spark.sparkContext.applicationId}"
    if folder not in _SCRATCH:
        _SCRATCH.add(folder)
        files.delete_at_end(spark, folder)
    return folder


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A new, unused path under the shared folder, grouped by application id."""
    return f"{_scratch(spark)}/{stem}_{uuid.uuid4().hex[:12]}"


def fresh_table(spark: SparkSession, stem: str) -> str:
    """A new table name in this application's scratch database."""
    app = spark.sparkContext.applicationId
    database = "marketlake_" + re.sub(r"\W", "_", app)
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} "
        f"LOCATION '{_scratch(spark)}/{database}.db'"
    )
    return f"{database}.{stem}_{uuid.uuid4().hex[:12]}"
