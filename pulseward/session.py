"""SparkSession construction and the shared checkpoint folder.

Python workers need the package: on a cluster submit it with ``--py-files``; in local mode ``get_spark``
puts the repository on the workers' PYTHONPATH.

The library never creates a session implicitly inside an operator; callers pass one in.
``get_spark`` is a convenience for tests, the bench and local runs.
"""

from __future__ import annotations

import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job here relies on. Time zone UTC keeps epoch-ms arithmetic stable. Broadcasts are decided
# only at run time: the static threshold (based on size *estimates*) is off, and AQE turns a join into a
# broadcast only after it has measured the small side; AQE also splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "pulseward", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """A session with the settings above where the submission has not set them. ``master``, ``shuffle_partitions``
    and ``extra`` are set only if given: launched by spark-submit, its master and its settings hold."""
    _export_pythonpath()
    own = dict(extra or {})
    if shuffle_partitions is not None:
        own["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master is not None:
        own["spark.master"] = master
    asked = SparkConf(loadDefaults=False)
    for k, v in own.items():
        asked.set(k, v)
    SparkContext._ensure_initialized(conf=asked)   # starts the JVM, which knows what was submitted
    submitted = SparkConf()
    builder = SparkSession.builder.appName(submitted.get("spark.app.name", app))
    for k, v in {**{k: v for k, v in BASE_CONF.items() if not submitted.contains(k)}, **own}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _export_pythonpath() -> None:
    """Local mode: Python workers inherit the JVM's environment, so the repository root on PYTHONPATH
    (set before the JVM starts) makes ``pulseward`` importable in them. Clusters use ``--py-files``."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *parts])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster the setting must name a shared folder and is only read here. Only a local-mode session
    without the setting (tests, the bench) gets a fresh scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this client (e.g. Spark Connect): the setting is required
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pulseward-ckpt-"))
    return sc.getCheckpointDir()

