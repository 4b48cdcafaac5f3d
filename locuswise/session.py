"""Session helper for tests, benchmarks and local runs. A cluster brings its own session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_MADE: dict[str, str] = {}  # the local folder of an application that names none


def local_session(cpus: int | None = None, app: str = "locuswise") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOCUSWISE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cutting lineage.

    The cluster names it in ``spark.checkpoint.dir``; a local folder is made only when no
    name is set, which is the case in single-machine tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _MADE:
        _MADE[app] = tempfile.mkdtemp(prefix="locuswise-ckpt-")
    return _MADE[app]
