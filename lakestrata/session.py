"""Session building and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from lakestrata.sources import fs

INITIAL_PARTITIONS = "20000"

_local_roots: dict[str, str] = {}


def build_session(app: str = "lakestrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes.

    Adaptive execution only ever lowers the number of shuffle partitions, so shuffles start with
    ``INITIAL_PARTITIONS`` and are merged to partitions of the advisory size. Pass
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` for small local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", INITIAL_PARTITIONS)
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def session_with(spark: SparkSession, **conf: str) -> SparkSession:
    """A session of its own with the SQL settings of ``spark``, but for those of ``conf`` (under ``spark.sql.``)."""
    own = spark.newSession()
    for key, value in spark.sql("SET").collect():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in conf.items():
        own.conf.set(f"spark.sql.{key}", value)
    return own


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session may run without it; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lakestrata-")
        context.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the scratch root of this application."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/lakestrata/{app}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below the scratch root; call it at the end of a job."""
    fs.delete(spark, f"{scratch_root(spark)}/lakestrata/{spark.sparkContext.applicationId}")
