"""Session helpers.

Library code never builds its own session: every operator takes DataFrames and uses
``df.sparkSession``.  ``local_session`` is for tests, the bench and examples only.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Bytes of a batch for Python workers, and the setting that bounds them.
BATCH, BATCH_BYTES = 2 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cores: str = "*", app: str = "veracity", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = {**LOCAL_CONF, **extra}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a folder that the driver and all executors share, and is
    only read; it is an error if it is missing there.  Only a session in one JVM (tests)
    gets a scratch folder of its own when it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master or ""
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="veracity-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that they can import it wherever it is run from.

    Once per Spark application; Spark distributes the archive.
    """
    sc = spark.sparkContext
    if getattr(sc, "_veracity_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="veracity-py-"), "veracity")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    sc._veracity_shipped = True


def bound_batches(spark: SparkSession) -> None:
    """Let a batch that goes to a Python worker hold about ``BATCH`` bytes, not 10,000 rows of any length.

    What a worker makes of a batch (words, tokens) is many times its size; so bounded, its memory
    does not grow with the table.  A smaller setting of the session stays."""
    number, unit = re.fullmatch(r"(\d+)([kmg]?)i?b?", spark.conf.get(BATCH_BYTES).strip().lower()).groups()
    if int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH:
        spark.conf.set(BATCH_BYTES, str(BATCH))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
