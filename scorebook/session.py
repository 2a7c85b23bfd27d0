"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "scorebook", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    width = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Only a session whose master is local, so that driver and executors are one process, may go without that setting;
    it gets a folder of its own. A local cluster has executors apart and may not.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[[^-]*\])?$", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="scorebook-")
    return _LOCAL_DIRS[app]


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Unlike a cached frame it survives the loss of every executor, and unlike a local checkpoint its
    blocks do not live on one machine.
    """
    spark = df.sparkSession
    target = f"{shared_dir(spark)}/scorebook/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    written.written_to = target
    return written


def observed(watch: Observation, recount: Callable[[], DataFrame]) -> dict[str, Any]:
    """Counters of a finished write; counted again from ``recount`` if the plan carried none.

    Spark drops the counters together with a plan it finds to be empty while running.
    """
    try:
        return watch.get
    except Py4JJavaError:
        return recount().first().asDict()
