"""SparkSession helpers shared by the pipeline, tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on; each one is a documented Spark option.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML pages reach ~100 KB: keep a Python worker's Arrow batch well under 1 GB
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # documents run to ~20 000 words: 1024-row Parquet batches keep a text
    # column vector in the tens of MB instead of hundreds
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    # run-time (measured) broadcast of a dimension up to 64 MB, e.g. ~1M companies
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "souk", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library's defaults.

    On a cluster, leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only where that is
    unset and the master is local, a private folder is made; on a cluster the
    other machines could not see it, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="souk-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
