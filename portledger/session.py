"""Session settings and the shared folder used to cut lineage."""

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def _submitted():
    """Settings that came with the submission of this driver."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ and SparkContext._jvm is None:
        return set()
    SparkContext._ensure_initialized()
    return {key for key, _ in SparkConf().getAll()}


def build_session(app="portledger", master=None, **conf):
    """A session with the settings the jobs expect; settings of the submission win, those of ``conf`` win over both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Checkpoint files go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    known = _submitted()
    defaults = {key: value for key, value in defaults.items() if key not in known}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark):
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own: on a cluster a machine-local
    folder is lost with its machine.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    if not root:
        known = sc.getCheckpointDir()
        if known:
            return known.rsplit("/", 1)[0]
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="portledger-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark, name):
    """A fresh folder name below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def pinned(df):
    """``df`` cut from its lineage by a reliable checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()
