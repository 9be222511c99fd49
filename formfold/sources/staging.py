"""Small files and copies on storage that all executors share.

Copies cut a lineage, are read more than once at the price of a scan, and survive the loss of an
executor.  A run deletes its own at its end; what a lazily read result stands on stays until
the application ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []
_kept: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession, otherwise: str | None = None) -> str | None:
    """The folder a caller gives for such copies, else the one the cluster names, if any."""
    return otherwise or spark.conf.get("spark.checkpoint.dir", None)


def working_folder(spark: SparkSession) -> str:
    """The shared folder; without one a temporary folder, if executors are threads of this process."""
    if named := shared_folder(spark):
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="formfold-"))
    return _local[0]


# ---- small files -------------------------------------------------------------------

def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of whatever store its path names."""
    place, store = _store(spark, path)
    store.delete(place, True)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where the folder is not there."""
    place, store = _store(spark, folder)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place))


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all."""
    place, store = _store(spark, f"{path}.{uuid.uuid4().hex}")
    out = store.create(place)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not store.rename(place, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"could not write {path}")


def read_file(spark: SparkSession, path: str) -> str:
    place, store = _store(spark, path)
    source = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


# ---- the driver's memory -----------------------------------------------------------

def give_back(spark: SparkSession) -> None:
    """The driver's JVM gives the system what it has freed of its native memory.

    Planning and compiling a hundred columns takes and frees much of it, in arenas that the C
    library keeps for each thread.  Where the JVM has no such command nothing is done.
    """
    jvm, new = spark._jvm, spark.sparkContext._gateway.new_array
    with suppress(Py4JError):
        types, given = new(jvm.Class, 4), new(jvm.Object, 4)
        for i, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            types[i] = jvm.Class.forName(name)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        # by the interface's method: the class of the server is not open to callers
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", types).invoke(server, given)


# ---- copies ------------------------------------------------------------------------

def kept_folder(spark: SparkSession, folder: str) -> str:
    """Where an application's copies are that nobody deletes before it ends."""
    path = f"{folder}/copies-{spark.sparkContext.applicationId}"
    if path not in _kept:
        _kept[path] = spark
        if len(_kept) == 1:
            atexit.register(sweep)
    return path


def sweep() -> None:
    """Delete the copies of this application.  Results that stand on them can no longer be read."""
    while _kept:
        path, spark = _kept.popitem()
        if spark.sparkContext._jsc is not None:  # a stopped session can delete nothing
            with suppress(Py4JError, OSError):  # nor one whose JVM has gone
                remove(spark, path)


def written(df: DataFrame, what: str, folder: str | None, **options: str) -> DataFrame:
    """The rows read back from a copy; without a folder, the plan itself."""
    if not folder:
        return df
    path = f"{kept_folder(df.sparkSession, folder)}/{what}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
