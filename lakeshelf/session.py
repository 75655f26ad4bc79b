"""Session builder and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_folder: str | None = None

# The JVM never compiles a method over 8000 bytes.  A wide cleaning projection
# generates one that is larger and would run interpreted; with this limit Spark
# splits it over small methods instead.
RUNTIME_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Codes and repeated text take some 10 to 50 bytes a row in a shuffle or a file, and many times that as
# rows to sort.  Spark sizes tasks by the former: by default up to 64 and 128 MB, millions of rows.
TASK_BYTES = 16 << 20
TASK_CONF = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")

# A small task of a partitioned write holds rows of few partitions, a file of each may be open at once;
# rows of further partitions are sorted, as all are by default.
OPEN_FILES = 16
FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def build_session(app: str = "lakeshelf", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and ANSI on.

    Everything sized to a cluster (executors, memory, upper bound of shuffle
    partitions) is left to the submit command; AQE coalesces from that bound.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    tune(session)
    return session


def tune(spark: SparkSession) -> None:
    """Runtime settings the wide projections need; a value already chosen is kept."""
    for key, value in RUNTIME_CONF.items():
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks of at most ``TASK_BYTES`` of shuffle or files, for writes of wide rows, which then need no sort by partition.

    A smaller size already chosen is kept, and so is a number of open files.
    """
    chosen = {key: spark.conf.get(key, None) for key in (*TASK_CONF, FILES_CONF)}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key in TASK_CONF:
        if chosen[key] is None or in_bytes(chosen[key]) > TASK_BYTES:
            spark.conf.set(key, str(TASK_BYTES))
    if chosen[FILES_CONF] is None:
        spark.conf.set(FILES_CONF, str(OPEN_FILES))
    try:
        yield
    finally:
        for key, value in chosen.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it; a cluster job that has no shared
    folder is refused, since a folder of one machine is not seen by the others.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="lakeshelf-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created there yet."""
    return f"{shared_folder(spark)}/lakeshelf/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path`` whose write was finished."""
    files, at = _file_system(spark, path)
    if not files.exists(at):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return [
        f.getPath().getName()
        for f in files.listStatus(at)
        if f.isDirectory() and files.exists(done(f.getPath(), "_SUCCESS"))
    ]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of all folders right below ``path``, as they are on disk."""
    files, at = _file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(at) if f.isDirectory()] if files.exists(at) else []


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove data that no reader needs any more; whether there was any."""
    files, at = _file_system(spark, path)
    return files.delete(at, True)


def rename_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file within a file system; done already if only the target is there."""
    files, at = _file_system(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(to.getParent())
    if not files.rename(at, to) and not (files.exists(to) and not files.exists(at)):
        raise OSError(f"{source} could not be moved to {target}")


_stored: list[str] = []


def store(spark: SparkSession, df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a written table, so a lost executor costs a re-read
    of files and not a re-run of everything upstream.  ``forget_stored`` removes it.
    """
    path = new_path(spark, name)
    df.write.parquet(path)
    _stored.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_stored(spark: SparkSession) -> int:
    """Remove every table that ``store`` has left so far; for when the results made of them are no longer read."""
    removed = 0
    while _stored:
        removed += remove_folder(spark, _stored.pop())
    return removed
