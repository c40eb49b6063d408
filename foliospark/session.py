"""Session settings and the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Settings for a session of one's own; a given session is left as it is.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def session(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(master).config(map=SETTINGS).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only where it is unset and
    Spark runs in a single process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="foliospark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


#: Paths that this process has given out.
_GIVEN: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/foliospark/{name}-{uuid.uuid4().hex}"
    _GIVEN.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_tables(spark: SparkSession) -> int:
    """Delete the tables that this process wrote, once results that read them
    have been written elsewhere. Gives their number."""
    n = len(_GIVEN)
    while _GIVEN:
        _delete(spark, _GIVEN.pop())
    return n


def discard(*frames: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again: what was
    made of them has been written."""
    for frame in frames:
        path = vars(frame).get("table_path")
        if path:
            _delete(frame.sparkSession, path)
            if path in _GIVEN:
                _GIVEN.remove(path)


#: Part of its largest heap from which the driver's JVM collects garbage after a table.
HEAP_PART = 0.5


def give_back(spark: SparkSession) -> None:
    """Let the driver's JVM give freed memory back to the system.

    Planning many queries leaves garbage that G1 keeps in a grown heap, and
    freed native blocks (of the compiler, above all) that glibc keeps.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    runtime = jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > HEAP_PART * runtime.maxMemory():
        gc.collect()  # plans that only dropped frames hold
        jvm.java.lang.System.gc()
    try:
        args = gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        args[2], args[3] = gateway.new_array(jvm.java.lang.Object, 0), gateway.new_array(jvm.java.lang.String, 0)
        # the server's class is closed to reflection, its interface is not
        methods = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods()
        next(m for m in methods if m.getName() == "invoke").invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # JVMs without glibc or of earlier versions have no such command
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    give_back(df.sparkSession)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.table_path = path
    return made
