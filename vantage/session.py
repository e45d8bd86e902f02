"""Session construction and lineage checkpoints."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every vantage job wants. AQE re-plans joins/aggregates at runtime
# (coalesces small shuffle partitions, splits skewed ones, turns a small side
# into a broadcast when the measured size allows it).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # counts by partition come from file footers where a source allows it
    "spark.sql.parquet.aggregatePushdown": "true",
    # columnar files are smaller than their rows: sizes compared with the broadcast threshold count them so often
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "vantage",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with vantage's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (AQE coalesces downwards). Locally pass e.g. ``local[8]`` and 8.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; it is used as is.
    Only in local mode, when the setting is absent (tests), is a scratch folder
    created; on a cluster a missing setting is an error, never a machine-local
    folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's object store)")
        configured = tempfile.mkdtemp(prefix="vantage-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def cluster_conf(total_cores: int, input_bytes: int | None = None, max_partitions: int = 100_000) -> dict[str, str]:
    """Starting configuration for a large cluster (pass to ``build_session(conf=...)``).

    * scans split files at 256 MB, so every task reads a bounded slice;
    * shuffles start wide (4 x cores, or one partition per GB of input, capped)
      and AQE coalesces them to ~256 MB partitions, so reducers do not spill;
    * AQE splits a skewed join partition (> 512 MB and 5 x the median).
    """
    mb = 1 << 20
    wide = max(4 * total_cores, (input_bytes or 0) // (1 << 30))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.shuffle.partitions": str(min(wide, max_partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * mb),
    }
