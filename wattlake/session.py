"""Session, table access and lineage helpers shared by all operators."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", shuffle_partitions: int = 8, app: str = "wattlake") -> SparkSession:
    """A single-node session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WATTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application: functions that run in their Python workers import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="wattlake-ship-")) / "wattlake_package.zip"  # Spark's file server hands it out
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f"{here.name}/{f.relative_to(here)}")
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir`` (a file or a directory of part files)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, that ``spark.checkpoint.dir`` names; a folder of our own on a single node only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if spark.sparkContext.applicationId not in _OWN:
        _OWN[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="wattlake-shared-")
    return _OWN[spark.sparkContext.applicationId]


_OWN: dict[str, str] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Between the phases of a long query: collect the garbage of the driver, and with it what finished phases still hold.

    Shuffle files, broadcasts and checkpoints are removed when the driver collects the objects that stand for them, which
    it does only as its memory fills. What the JVM has freed outside of its heap goes back to the system too.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    give_back(spark)


def give_back(spark: SparkSession) -> str:
    """Have the driver's C library return freed memory, which it may keep: hundreds of MB after many plans.

    Gives what the JVM says of it, which is nothing where it doesn't know the command (an older one, or one without glibc).
    """
    jvm = spark.sparkContext._jvm
    try:
        # by the interface, as the server's own class isn't open to reflection
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        told = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        told[0], told[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), told) or ""
    except Py4JError:
        return ""


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cores before per-row Python work, if the plan alone wouldn't.

    Only the plan depends on the estimated size, never the result. A scan that already gives every core a partition is left as it is, and so is what comes out of a
    shuffle large enough to be cut into a piece for every core; nothing is moved twice at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan()
    if any(x in plan.toString() for x in ("Join", "Aggregate", "Window", "Repartition", "Distinct", "Sort")):
        if int(plan.stats().sizeInBytes()) > cores * (64 << 20):
            return df
    elif df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * 2)
