"""SparkSession construction and cluster-level settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the marts are tuned for.

    AQE stays on so partition counts coalesce to the data and skewed
    join partitions are split at run time. The session time zone is
    UTC: every stored timestamp is zone-less, and no model depends on a
    local zone. On a cluster ``master`` is left to ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Lenient CSV loads flag rows with a wrong field count; that flag
        # must not depend on which columns a query happens to read.
        "spark.sql.csv.parser.columnPruning.enabled": "false",
        # Large ranks and place tables checkpoint intermediate results;
        # drop those files once nothing references them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir``; only when the setting is absent
    and the master is ``local[...]`` (tests) is a new temporary folder
    set. On a cluster a missing setting is an error, never a machine-local
    folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="quarry-checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current
