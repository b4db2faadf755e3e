"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settings a release job should run with. Partition counts and memory belong to
# the cluster; these only make sure the run-time re-planning is switched on.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """A session for tests and benches; production sessions come from the cluster."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rxtally")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by the session; a scratch one only on an unset local session."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="rxtally-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and carry on from the copy.

    Used on small published aggregates that several later steps read, so the
    scan and the patient-grain shuffle behind them run once. The copy is a
    parquet table: later steps read only the columns they use, and Spark knows
    its size before it plans a join.
    """
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/cut-{uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
