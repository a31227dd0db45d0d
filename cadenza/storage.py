"""The folder all executors share: written tables that cut lineage, markers, renames."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch while a table is written: whole texts make the default of 10,000 too large for an executor's Python workers.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000

#: The JVM's command (glibc alone has it) that hands freed native memory back.
TRIM = "systemTrimNativeHeap"

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where that is unset, a local one if the master is local, too."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    return _LOCAL_DIRS.setdefault(app, f"file:///tmp/checkpoints/{os.getpid()}-{uuid.uuid4().hex[:8]}")


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path of any kind that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """``staged`` in the place of ``path``; the old one is set aside until the new one is there."""
    fs, new = file_system(spark, staged)
    _, where = file_system(spark, path)
    _, old = file_system(spark, f"{path}.old-{uuid.uuid4().hex[:8]}")
    if fs.exists(where):
        fs.rename(where, old)
    else:
        fs.mkdirs(where.getParent())
    if not fs.rename(new, where):
        fs.rename(old, where)
        raise OSError(f"could not put {staged} in the place of {path}")
    fs.delete(old, True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most BATCH_ROWS rows in what runs within."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(int(before), BATCH_ROWS)) if int(before) > 0 else str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def trim_native_heap(spark: SparkSession) -> bool:
    """Gives what the driver's JVM has freed outside its heap back to the system; False where the JVM has no such command.

    Plans, compiled code and network buffers come and go by the hundred; the allocator keeps their pages, which adds to the process for good.
    """
    sc = spark.sparkContext
    java, array = sc._jvm.java.lang, sc._gateway.new_array
    try:
        # by the interface, as the server's own class is closed to callers
        kinds = array(java.Class, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = java.Class.forName(kind)
        given = array(java.Object, 4)
        given[0], given[1] = sc._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), TRIM
        java.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(java.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        return False
    return True


class Scratch:
    """A folder for one run's intermediate tables below the shared folder.

    Lineage is cut by writing a table there and reading it again, so a lost executor costs a re-read.
    The folder goes when the session ends, since lazy results may read it until then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._fs, where = file_system(spark, self.path)
        self._fs.mkdirs(where)
        self._fs.deleteOnExit(where)

    def dir(self, name: str) -> str:
        return f"{self.path}/{name}"

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """``df`` written as a table of this folder and read again."""
        with small_batches(self.spark):
            df.write.mode("overwrite").options(**options).parquet(self.dir(name))
        heap = self.spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
        if 2 * (heap.totalMemory() - heap.freeMemory()) > heap.maxMemory():
            self.release()
        else:
            trim_native_heap(self.spark)
        return self.spark.read.schema(df.schema).parquet(self.dir(name))

    def release(self) -> None:
        """Lets go of the shuffle files of queries that have ended.

        Spark deletes them when the driver's JVM collects their plans, by default at its own leisure; between the large steps of one
        run they would add up on the executors' disks. Memory that the JVM has freed outside its heap goes, too.
        """
        self.spark.sparkContext._jvm.System.gc()
        trim_native_heap(self.spark)

    def finish(self, df: DataFrame) -> DataFrame:
        """``df`` as the run's last table; all others of the folder go, so a run leaves its result alone."""
        out = self.table(df, "result")
        for name in names_in(self.spark, self.path):
            if name != "result":
                self.drop(name)
        self.release()
        return out

    def drop(self, name: str) -> None:
        """Deletes a table that nothing reads any more."""
        delete(self.spark, self.dir(name))
