"""Session helpers: building a local session for tests and benches, and
lineage cutting for iterative jobs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The session settings every quarry job expects.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # iterative operators re-plan on top of their previous round; inferred
    # constraints would otherwise grow with every round
    "spark.sql.constraintPropagation.enabled": "false",
}


# Shuffle files of a finished write have no reader left: without this they stay
# on the executors' disks until the driver happens to collect garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", partitions: int = 8,
                  app: str = "quarry", memory: str = "8g") -> SparkSession:
    """A local-mode session with the quarry defaults (tests, bench)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.driver.memory", memory))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` must name a folder that the driver
    and all executors share.  Only in local mode, where there is one machine,
    a scratch folder is made if it is unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = (sc.getConf().get("spark.checkpoint.dir", None)
                or spark.conf.get("spark.checkpoint.dir", None))
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared checkpoint folder and read
    it back.

    Used by iterative operators every round or few rounds: a lost executor
    re-reads the written table instead of replaying every round, and the
    next round plans against a plain scan (no inherited constraints or
    statistics from the previous plans). The write's own shuffle files go with
    its end, so that disk holds those of one round, not of all."""
    spark = df.sparkSession
    path = scratch_path(spark, f"cut-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
