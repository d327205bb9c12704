"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator here relies on.  Joins with a hot key are split by
# AQE at run time; the force flag keeps that split even where an aggregate on
# the same key follows the join (it costs one extra shuffle of partial sums).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # JSON objects with a repeated key are valid; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "metascope", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A tuned session; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` below the cluster's shared checkpoint folder.

    Without ``spark.checkpoint.dir`` a temporary folder is used, but only on a
    local master: on a cluster executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="metascope-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
