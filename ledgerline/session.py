"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every job relies on. Shuffle width, memory and file split size stay
#: with the cluster; AQE coalesces or splits partitions at run time.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "12g", shuffle_partitions: int = 8) -> SparkSession:
    """A single-process session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-warehouse-"))
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Spark's switch for it; an older Spark does not know it and keeps the files until its cleaner runs.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each job in here go as soon as the job ends.

    They would stay until the driver collects its garbage, those of load after load side by side. For writes: what
    is written needs them no more. Rows that are to be computed again must not be collected in here.
    """
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a session in one
    process (tests, a laptop) may lack it and gets a temporary folder of its own; on a cluster
    executors could not see that.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-")
    return f"{root.rstrip('/')}/ledgerline/{purpose}-{uuid.uuid4().hex}"
