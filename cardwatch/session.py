"""Session construction and shared settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (feeds carry naive local
# times, kept as timestamp_ntz), AQE for runtime re-planning (broadcast of
# small join sides, partition coalescing, skew-join splitting), and dynamic
# partition overwrite so that a rerun of one day replaces only that day.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Job-level commit: a failed or retried append exposes no partial files.
    "spark.hadoop.mapreduce.fileoutputcommitter.algorithm.version": "1",
}


# Cluster default when nothing else sets it: one day of a 100 TB fact is
# about 300 GB of shuffle, i.e. ~75 MB per partition at 4000.  AQE merges
# small partitions (towards spark.sql.adaptive.advisoryPartitionSizeInBytes)
# but never splits large ones, so over-provisioning is the safe side.
CLUSTER_SHUFFLE_PARTITIONS = 4000


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cardwatch",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset so spark-submit decides.  Shuffle
    partitions: ``shuffle_partitions`` if given, else the cluster's own
    setting, else :data:`CLUSTER_SHUFFLE_PARTITIONS` (local masters keep
    Spark's default unless given).
    """
    from pyspark import SparkConf

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not (master or "").startswith("local") and not SparkConf().contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = str(CLUSTER_SHUFFLE_PARTITIONS)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; ``fallback`` is applied only when the
    session has none (as in tests).  Never a machine-local folder on a cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback:
        spark.conf.set("spark.checkpoint.dir", fallback)
        spark.sparkContext.setCheckpointDir(fallback)
        return fallback
    return None
