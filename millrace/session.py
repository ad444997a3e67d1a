"""Session construction and session-derived settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import QueryError


def build_session(app: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator assumes (UTC, AQE, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def chunk_count(spark: SparkSession) -> int:
    """How many pieces a possibly hot group is cut into: follows the cluster's parallelism."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(512, 2 * width))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; on a local master that names none, a folder in the warehouse."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not context.master.startswith("local"):
        raise QueryError("set spark.checkpoint.dir to a folder all executors share")
    return shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/shared"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    Used between rounds of an iteration, and where a folded frame is read several times: the
    branches prune different columns, so without it each would fold the raw rows again.
    Only when the session names no folder (tests) is one set, in the session's warehouse.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
