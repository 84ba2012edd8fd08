"""SparkSession construction and cluster-safe settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every operator relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # Python call-site capture for error messages: costs Python stack
    # inspection on every Column operation; off in production runs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "cadence",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the benchmark (a cluster passes its own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(
    input_bytes: int,
    split_bytes: int = 256 << 20,
    shuffle_partition_bytes: int = 128 << 20,
    shuffle_fraction: float = 0.25,
) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    * Scan splits of ``split_bytes`` (Parquet row groups are the unit).
    * The initial shuffle partition count is sized so that the expected
      shuffle volume (``shuffle_fraction`` of the input: column pruning
      keeps 2-4 columns, partial aggregation shrinks most exchanges) lands
      near ``shuffle_partition_bytes`` per partition. Each partition then
      fits executor memory with room to spare. AQE coalesces partitions
      that come out small and splits skewed join partitions.
    """
    expected_shuffle = max(1, int(input_bytes * shuffle_fraction))
    partitions = max(200, expected_shuffle // shuffle_partition_bytes)
    return {
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
    }
