"""Session settings and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from weakref import WeakKeyDictionary, WeakSet

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every report relies on. They hold no sizes: partition counts are left to
# the cluster's own configuration and to adaptive coalescing.
#
# forceOptimizeSkewedJoin lets a hot join key be split even where the split costs one more
# shuffle further up; without it one straggling task would hold the whole report.
# fileCompressionFactor makes the size check before a broadcast look at about the decoded size
# of a table, not at its compressed files.
# ansi: a sum that does not fit its type must fail, not wrap.
RUNTIME_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# What a job has shuffled is removed when the job ends. Otherwise it stays on the executors' disks until the driver
# happens to collect its garbage. For sessions that compute no DataFrame twice: the second time would begin anew.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "bazaarlens", master: str | None = None, **settings: str) -> SparkSession:
    """Build a session with the runtime settings; ``settings`` use ``_`` in place of ``.``."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("_", "."), value)
    return tune(builder.getOrCreate())


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[SparkSession]:
    """Remove what the jobs begun inside have shuffled as soon as each has ended."""
    before = {name: spark.conf.get(name, None) for name in DROP_SHUFFLES}
    for name, value in DROP_SHUFFLES.items():
        spark.conf.set(name, value)
    try:
        yield spark
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def ship(spark: SparkSession) -> SparkSession:
    """Make a session fit for tasks in Python: give them this package, so that it need be on the driver's
    path only, and whole texts in batches of few rows and bytes, as rows may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    context = spark.sparkContext
    if context not in _SHIPPED:
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="bazaarlens-")) / "bazaarlens.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
            for module in sorted(package.rglob("*.py")):
                file.write(module, module.relative_to(package.parent))
        # Executors fetch it from the driver, as they do with --py-files; addPyFile keeps a copy.
        context.addPyFile(str(archive))
        _SHIPPED.add(context)
    return spark


_SHIPPED: WeakSet[SparkContext] = WeakSet()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: what spark.checkpoint.dir names, else one under the warehouse.

    The same on any master. The warehouse holds the tables that every executor reads and writes, so
    whatever runs loads and reports can reach it. A warehouse on the driver's own disk is refused on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_rows"
    if _file_system(spark, folder).getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, so that all later uses read the same rows.

    The rows are written as Parquet: later uses read just their columns, a count just the file
    footers, and lost executors cost no recomputation. `release` removes them; what a lazy
    result still reads goes when the driver ends, also if its session was stopped before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


def release(*stored: DataFrame) -> None:
    """Remove the rows of `materialize`; only when no result that reads them is still to be computed."""
    for df in stored:
        path = _STORED.pop(df, None)
        if path:
            remove_folder(df.sparkSession, path)


# Where materialized rows lie, as long as somebody holds the DataFrame.
_STORED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's JVM ends, if it is still there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = _file_system(spark, path)
    # Only what exists can be marked.
    files.mkdirs(place.getParent())
    files.mkdirs(place)
    files.deleteOnExit(place)
    files.delete(place, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = _file_system(spark, path)
    files.delete(place, True)
    files.cancelDeleteOnExit(place)
