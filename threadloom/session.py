"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Estimated bytes per core below which an input is spread.
WIDEN_BYTES = 4 << 20

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the defaults the operators expect.

    Keyword names use ``__`` for the dots of a Spark setting, e.g.
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may fall
    back to a temporary folder; a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="threadloom-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/threadloom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of iterative plans, pins the result of anything that must
    not be evaluated twice, and gives the next step real table statistics.  A
    lost executor only costs the tasks that were reading it.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widen(df: DataFrame) -> DataFrame:
    """Spread a table that was read as fewer partitions than there are cores.

    Only small inputs qualify, by the optimizer's estimate of their size: no
    job runs, and a table or a join of more bytes stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if estimate < cores * WIDEN_BYTES else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per application)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="threadloom-zip-")) / "threadloom"), "zip", root.parent, root.name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
