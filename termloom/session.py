"""Session settings and the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs here rely on. Anything sized to a cluster (executors, memory, the number
# of shuffle partitions) is left to spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Long texts: bound an Arrow batch by bytes and not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(app: str = "termloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which a cluster shares as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
