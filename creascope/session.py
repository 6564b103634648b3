"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that let one plan serve both a laptop and a large cluster: adaptive
# execution picks broadcast joins from measured sizes, splits skewed join partitions and
# merges small shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "creascope", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own.
    """
    try:
        configured = spark.conf.get("spark.checkpoint.dir")
    except Exception:
        configured = None
    context = spark.sparkContext
    if not configured:
        configured = context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="creascope-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Cuts the lineage before work that scans the same rows several times. The table is
    columnar, so later scans read only the columns they use, its size is known to the
    planner, and a lost executor costs no recomputation of what came before. Tables lie below
    the application id, so they can be removed once the application has ended.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/creascope/{application}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
