"""Session helper: sane defaults for local tests and for a cluster.

On a cluster the session is created by the platform; ``get_session`` only
fills in defaults the launch configuration left unset. The checkpoint folder is read from
``spark.checkpoint.dir``; a local temporary folder is only used when the
setting is absent (tests on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # No broadcast from file-size estimates: dimension sides are broadcast
    # explicitly, behind a row-count check or a structural bound
    # (operators/broadcast.py); everything else shuffles.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # AQE sizes shuffle partitions from runtime statistics: a cluster sets
    # spark.sql.shuffle.partitions high (about the largest shuffle / 128 MB)
    # and AQE merges the small ones and splits skewed ones.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_session(master: str | None = None, app: str = "featuremart",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """The session with the defaults above filled in where the launch
    configuration (spark-submit, cluster settings) left them unset; values
    passed here (``shuffle_partitions``, ``extra``) always apply."""
    from pyspark import SparkConf

    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    launch = active.sparkContext.getConf() if active is not None else SparkConf()
    conf = {k: v for k, v in DEFAULT_CONF.items() if not launch.contains(k)}
    conf.update(explicit)
    if active is not None:
        for k, v in conf.items():
            if not k.startswith("spark.ui."):  # static; fixed at launch
                active.conf.set(k, v)
        spark = active
    else:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        for k, v in conf.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fm-ckpt-"))  # one machine, as in tests
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def staged(spark: SparkSession, df, name: str):
    """Write ``df`` once below the shared checkpoint folder and read it back:
    several consumers then share one evaluation of its plan."""
    path = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scratch_root: ContextVar[str] = ContextVar("scratch_root", default="")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables beside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "featuremart", _scratch_root.get(), name)


@contextmanager
def scratch_root(spark: SparkSession, name: str):
    """Keeps the intermediate tables made inside together, and removes them at
    the end: what is to outlive them must be written elsewhere before."""
    own = f"{name}-{uuid.uuid4().hex}"
    token = _scratch_root.set(own)
    try:
        yield
    finally:
        _scratch_root.reset(token)
        remove_folder(spark, scratch_dir(spark, own))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
