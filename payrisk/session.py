"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_KEY = "payrisk.scratch.dir"
STAGES_KEY = "payrisk.scratch.stages"


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on; ``conf`` adds or overrides.

    Connector packages, catalogs and credentials belong to spark-submit or the cluster, not here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the zone: event times are zone-less UTC text, so any other zone shifts every frame."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Change one SQL setting for the actions inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables and stream checkpoints.

    This is the cluster's ``spark.checkpoint.dir``. Only a local-mode session may fall back to a
    folder of its own; on a cluster other machines could not read it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="payrisk-")
    spark.conf.set(SCRATCH_KEY, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    known = spark.conf.get(STAGES_KEY, "")
    spark.conf.set(STAGES_KEY, f"{known}\n{path}" if known else path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage at a table that survives lost executors, gives later steps column pruning
    and real size statistics, and stops several consumers from recomputing the same shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_stages(spark: SparkSession) -> int:
    """Delete the scratch paths of this session. Call it once the results are written."""
    paths = [p for p in spark.conf.get(STAGES_KEY, "").split("\n") if p]
    jvm, hadoop_conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        removed += int(path.getFileSystem(hadoop_conf).delete(path, True))
    spark.conf.unset(STAGES_KEY)
    return removed
