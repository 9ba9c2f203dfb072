"""Session settings and intermediate tables in the shared folder."""

from __future__ import annotations

from urllib.parse import urlparse
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording a call site per column expression costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    ``conf`` keys use underscores for dots, so ``spark_driver_memory="8g"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


#: Intermediate tables written by this driver and not yet dropped.
_intermediates: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder intermediate tables go to: the session's ``spark.checkpoint.dir``,
    else one in the warehouse, which all executors must reach as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_one_machine = spark.sparkContext.master.startswith(("local[", "local-cluster")) or (
        spark.sparkContext.master == "local"
    )
    if not on_one_machine and urlparse(warehouse).scheme in ("", "file"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{warehouse}/_intermediate"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a table in the shared folder.

    It survives lost executors, is computed once, and unlike an RDD checkpoint
    keeps columnar reads, filters and the size by which joins are planned.
    """
    path = f"{shared_folder(df.sparkSession)}/starloom-{uuid4().hex}"
    df.write.parquet(path)
    track(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def track(path: str) -> None:
    """Count a folder this driver has others write as an intermediate table."""
    _intermediates.append(path)


def drop_intermediates(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Delete intermediate tables that this driver wrote, from the ``since``-th on
    and up to the ``until``-th; tells how many.  Frames that read them must not be
    used any more."""
    gone = _intermediates[since:until]
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    del _intermediates[since:until]
    return len(gone)


def intermediates() -> int:
    """How many intermediate tables this driver has written and not dropped."""
    return len(_intermediates)
