"""Session helpers: building a session for tests and finding the shared
folder for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lexispark", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    ckpt = os.environ.get("LEXISPARK_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="lexispark-ckpt-")
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.driver.memory", os.environ.get("LEXISPARK_DRIVER_MEM", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder, which is
    used as it is.  Only a local session may leave it unset: it then gets a
    folder of this machine.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="lexispark-ckpt-")
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def free_shuffles(spark: SparkSession) -> None:
    """From now on the files of an action's shuffles go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and a
    job of many actions needs the disk of all of them at once.  What a later
    action reads is written (``settled``, checkpoints) and not a shuffle."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def settled(df, name: str):
    """``df`` written to the shared folder and read again, for loops.  A
    checkpoint keeps the size that the plan before it was guessed to have, and
    a join's or cogroup's guess is a product, so in a loop of checkpoints the
    guess gets more digits every round until planning takes longer than the
    work; a table that was read has the size of its files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def dropped(df) -> None:
    """Deletes a table of ``settled`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.settled_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lexispark/{name}/{uuid.uuid4().hex}"
