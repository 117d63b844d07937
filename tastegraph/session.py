"""Session helpers.

The library never creates a global session: every operator takes DataFrames.
``local_session`` is for tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours should carry. On a cluster these come from
# spark-defaults; locally we set them here.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tastegraph", driver_memory: str = "16g") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session,
    whose server owns the checkpoint folder."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no driver-side context
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only when
    the session has none and runs in local mode (tests, bench). A cluster must
    name a shared folder in ``spark.checkpoint.dir``."""
    sc = _context(spark)
    current = checkpoint_dir(spark)
    if sc is None:
        if not current:
            raise RuntimeError("spark.checkpoint.dir is unset; name a shared folder for checkpoints")
        return current
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    master = sc.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset; name a shared folder for checkpoints")
    scratch = tempfile.mkdtemp(prefix="tastegraph-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    try:
        spark.conf.set("spark.checkpoint.dir", scratch)
    except Exception:  # a static conf in some deployments; the context already has it
        pass
    return sc.getCheckpointDir() or scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder, for written intermediate tables
    and streaming state (shared storage on a cluster)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df, name: str):
    """df written once to the shared checkpoint folder (Parquet) and read back: its lineage ends
    there, and every later use reads the same rows and only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df, name: str, keys: list[str], buckets: int | None = None):
    """df written in buckets by hash of ``keys`` (one sorted file each) as an external table of its own name
    in the shared checkpoint folder. Tables with the same buckets are joined on the keys
    without an exchange, as often as they are read."""
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    path = scratch_path(spark, name)
    table = "tastegraph_" + path.rsplit("/", 1)[-1].replace("-", "_")
    (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet")
     .saveAsTable(table))
    return spark.table(table)


class persisted:
    """``with persisted(df) as d:`` keeps ``df`` in memory/disk for the block and
    releases it afterwards (an explicit cache scope for a reused intermediate)."""

    def __init__(self, df, level=None):
        from pyspark import StorageLevel

        self.df = df
        self.level = level or StorageLevel.MEMORY_AND_DISK

    def __enter__(self):
        return self.df.persist(self.level)

    def __exit__(self, *exc):
        self.df.unpersist()
        return False


def shuffle_partitions(spark: SparkSession, default: int = 200) -> int:
    """The session's shuffle-partition count as an int (a non-numeric setting
    falls back to the default)."""
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return default
