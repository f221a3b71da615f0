"""Spark session and checkpoint-folder helpers.

The library never creates data on the driver: a session is only built here
for tests, the bench and command-line use. On a cluster the session comes
from the caller and ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every plan the library builds. AQE re-plans joins
# and coalesces small shuffle partitions at run time; skew-join splits hot
# partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # files of a dropped checkpoint go with it
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict:
    """Starting configuration for a cluster run over ``input_bytes`` of
    (compressed) input on ``total_cores`` task slots.

    * input splits of ``target_partition_bytes`` keep a scan task's working
      set well inside one executor core's share of memory;
    * the initial shuffle partition count is sized so a shuffle partition
      is about the same size (at least 3 waves of tasks), and AQE coalesces
      small partitions and splits skewed ones at run time;
    * broadcast stays at Spark's default threshold: the library broadcasts
      explicitly only tables whose size it has checked.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **DEFAULT_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def get_spark(app: str = "sparkprep", cpus: int | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return a local session (tests, bench). Cluster jobs pass their own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("SPARKPREP_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` from the session; only a local-mode
    session without one gets a private folder (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
    folder = tempfile.mkdtemp(prefix="sparkprep-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df):
    """Materialise ``df`` to the shared checkpoint folder (reliable, survives
    executor loss) and return the re-read DataFrame."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df, path: str | None = None, **options):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and return the table: smaller than a checkpoint where values repeat. The
    files go when the session ends. Rows are added to the table at ``path``
    (from ``new_table``) if it is given."""
    spark = df.sparkSession
    path = path or new_table(spark)
    df.write.mode("append").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_table(spark) -> str:
    """Where a table may be stored; its files go when the session ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
