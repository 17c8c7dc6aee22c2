"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    # Log times are wall-clock times without a zone; one fixed zone keeps
    # hour, weekday and window boundaries the same on every executor.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed
    # ones, and turns a sort-merge join into a broadcast join once the
    # real size of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "logloom", master: str | None = None, **conf) -> SparkSession:
    """Build or fetch a session with the recommended settings.

    Extra settings use ``__`` for dots (``spark__sql__shuffle__partitions=2000``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Set the session time zone on a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_LOCAL: dict[str, str] = {}
# Scratch folders and tables that this process made, by application.
_MADE: dict[str, list[tuple[str, str]]] = {}


def _local_scratch(spark: SparkSession) -> str:
    """A temporary folder of this process, on one machine only."""
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="logloom-")
    return _LOCAL[context.applicationId]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is visible to every executor.
    Only when it is unset (tests on one machine) a temporary folder is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_scratch(spark)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    note_scratch(spark, "folder", path)
    return path


def note_scratch(spark: SparkSession, kind: str, name: str) -> None:
    """Remember a scratch ``folder`` or ``table`` for ``clear_scratch``."""
    _MADE.setdefault(spark.sparkContext.applicationId, []).append((kind, name))


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders and tables this process made in this application, once their results are written.

    DataFrames that read them can't be used afterwards.  Returns how many were removed.
    """
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for kind, name in reversed(made):
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
    return len(made)


def materialize(df, purpose: str = "table"):
    """Cut the lineage: write to the shared scratch folder and read back.

    Used where one intermediate table feeds several later jobs.  The written
    files outlive any executor, unlike cached blocks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(spark: SparkSession, jobs: Sequence[Callable]) -> list:
    """Run independent Spark actions side by side; their results in order.

    Small jobs then share the executors instead of waiting for each other.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [s.result() for s in started]


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Fitting and scoring run package code inside tasks; a worker does not share
    the driver's import path.
    """
    context = spark.sparkContext
    if getattr(context, "_logloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="logloom-code-")) / f"logloom-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(Path(package.name) / source.relative_to(package)))
    context.addPyFile(str(archive))
    context._logloom_shipped = True
