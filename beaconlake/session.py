"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

# Settings that can change in a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Of duplicate keys in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Java compiles methods of up to 8000 bytes only; larger generated ones would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Newest-N by rank keeps N rows per task before the shuffle, whatever N; the default stops at 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
}


_local_folder: list[str] = []
_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the library expects to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", name: str = "beaconlake", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **RUNTIME_SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        # Noting the Python line of every column expression doubles the time to build a query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of the machine; on a cluster a folder of a machine's own
    file system is taken with a warning, as it is shared only if it is mounted everywhere.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if folder:
        if not local and file_system(spark, folder)[0].getScheme() == "file":
            warnings.warn(f"spark.checkpoint.dir is {folder}: all executors must see it", stacklevel=2)
        return folder
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="beaconlake-"))
    return _local_folder[0]


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path, as Spark reaches them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    fs, place = file_system(spark, path)
    fs.delete(place, True)


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """Within it, all scratch paths of this thread lie in one folder, which is removed at its end.

    The folder has the label's name alone, so that a scope begun anew after a crash removes what was left. Results must
    be written to their own place before the end.
    """
    folder = f"{shared_folder(spark)}/scope-{label}"
    delete_path(spark, folder)
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        delete_path(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, or in the scope's."""
    return f"{_scope.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write rows that several branches of a plan read to the shared folder, and read them back.

    Costly extraction then runs once, and a lost executor repeats a table scan only. Rows with whole texts take less
    disk with `compression="zstd"` than in the session's format.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
