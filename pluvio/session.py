"""Session construction and checkpoint-folder handling."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

TABLES = "pluvio_stored_"

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoint files of pinned intermediates are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# settings for a large cluster run (reading scan of ~100 TB, small downstream tables):
# big scan splits, AQE sizing shuffles from a large initial partition count, and
# skew splitting for joins whose keys are hot
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def get_session(master: str | None = None, app: str = "pluvio",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, UTC session time and no web UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context here
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # noqa: BLE001
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when none is set
    (tests and single-machine runs)."""
    sc = _context(spark)
    d = checkpoint_dir(spark)
    if sc is None:
        return d or fallback
    if d is None:
        sc.setCheckpointDir(fallback)
        d = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names. Only a local-mode session without one
    (tests, one machine) gets a temporary folder, set once."""
    d = checkpoint_dir(spark)
    if d is None:
        sc = _context(spark)
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        d = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="pluvio-ckpt-"))
    return d


def stored(df, keys, sort, by: str):
    """``df`` as a Parquet table in the shared folder, partitioned by the column ``by`` and
    laid out in as many buckets of ``keys`` as there are shuffle partitions, sorted by
    ``keys`` and ``sort``. Reading it needs no exchange for what is grouped, windowed or
    joined by ``keys``, and a filter on ``by`` reads the partitions that it leaves."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{TABLES}{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.partitionBy(by).bucketBy(n, *keys).sortBy(*keys, *sort)
     .option("path", f"{shared_folder(spark)}/{name}").format("parquet").saveAsTable(name))
    return spark.table(name)


def drop_stored(spark: SparkSession) -> None:
    """Drop the tables that ``stored`` made in this session, with their files."""
    for t in spark.catalog.listTables():
        if t.name.startswith(TABLES):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{t.name}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pin(df):
    """Reliable checkpoint that is always taken: for intermediates whose row
    placement must be identical for every consumer. Uses the session's checkpoint
    folder; only a local-mode session without one gets a temporary folder."""
    ensure_checkpoint_dir(df.sparkSession, shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
