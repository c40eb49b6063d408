import gc
import os
import time

import pytest

from foliospark import session


def test_tables_are_written_read_and_cleared(spark):
    session.clear_tables(spark)
    df = session.materialize(spark.range(10).withColumnRenamed("id", "x"), "t")
    assert df.columns == ["x"] and df.count() == 10
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    assert session.clear_tables(spark) == 1 and not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def _driver_mb(spark) -> int:
    pid = spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
    with open(f"/proc/{pid}/smaps_rollup") as found:
        return sum(int(line.split()[1]) for line in found if line.startswith(("Pss_Anon:", "Pss_Shmem:"))) // 1024


def test_the_driver_gives_freed_native_memory_back(spark):
    jvm = spark.sparkContext._jvm
    held = [jvm.java.nio.ByteBuffer.allocateDirect(48 << 10) for _ in range(4000)]
    full = _driver_mb(spark)
    kept = held[::100]  # freed blocks between held ones stay with the process
    del held
    gc.collect()
    for _ in range(3):
        jvm.System.gc()
        time.sleep(0.5)
    session.discard(session.materialize(spark.range(1), "t"))
    assert _driver_mb(spark) < full - 120 and len(kept) == 40


def test_the_driver_gives_a_grown_heap_back(spark):
    jvm = spark.sparkContext._jvm
    runtime = jvm.java.lang.Runtime.getRuntime()
    held = [jvm.java.nio.ByteBuffer.allocate(100 << 20) for _ in range(18)]
    grown = runtime.totalMemory()
    assert grown > 0.5 * runtime.maxMemory()
    del held
    time.sleep(1)  # the gateway lets go of them in a thread of its own
    session.discard(session.materialize(spark.range(1), "t"))
    assert runtime.totalMemory() < grown / 2
