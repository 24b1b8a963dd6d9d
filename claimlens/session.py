"""Session construction and lineage cutting.

On a cluster the session comes from the platform; ``get_session`` only fills in
settings that are unset.  Lineage is cut by tables written into the shared
folder named by ``spark.checkpoint.dir`` -- never a machine-local folder and
never ``localCheckpoint``.  Staged tables lie in one folder per application,
which ``drop_staged`` removes when no result that reads them is needed any more.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on; applied only where the session leaves them unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not compile methods over 8000 bytes of bytecode: such stages run without whole-stage code instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "claimlens") -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    running = SparkSession.getActiveSession()
    if running is not None:
        # a given session keeps its settings; only unset SQL settings are filled in
        for k, v in DEFAULT_CONF.items():
            if k.startswith("spark.sql.") and running.conf.get(k, None) is None:
                running.conf.set(k, v)
        return running
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor; give it the machine's memory
            builder = builder.config("spark.driver.memory", os.environ.get("CLAIMLENS_DRIVER_MEMORY", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a fresh scratch folder is
    made and registered in local mode only; on a cluster that folder would not be shared, so an
    error says to set it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="claimlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def staging_folder(spark: SparkSession) -> str:
    """Where this application's staged tables lie."""
    return f"{checkpoint_dir(spark).rstrip('/')}/claimlens-stage/{spark.sparkContext.applicationId}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    A lineage cut like ``checkpoint()``, but columnar: later readers prune columns
    and push filters into the scan.  The written table survives executor loss.  It
    stays until ``drop_staged`` or the end of the shared folder.
    """
    import uuid
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def code_cut(df: DataFrame) -> DataFrame:
    """The same rows; Spark's generated code ends here and begins anew for the steps above.

    HotSpot never compiles a method beyond 8000 bytes, and the code of a long projection is one method: its rows would be
    worked out by the bytecode interpreter to the end.  An observed row count is a step that passes rows on, outside
    whole-stage code, in their order and partitions; columns that nothing above reads are pruned through it.
    """
    import uuid
    from pyspark.sql import functions as F
    return df.observe(f"rows-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def drop_staged(spark: SparkSession) -> bool:
    """Remove all staged tables of this application; results that read them must have been written or collected before.

    Goes through Spark's own file system, so any shared store will do.  True if there was something to remove.
    """
    from claimlens.plans import extra, queries, v6
    app = spark.sparkContext.applicationId
    for cache in (v6._SEEDED, v6._MATERIALIZED, v6._SOME_COLUMNS, queries._V3_CACHE, queries._FD, queries._LAKE, extra._V2, extra._WRITTEN):
        for key in [k for k in cache if k[0] == app]:
            del cache[key]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``claimlens`` importable in Python workers (pandas and Arrow steps), once per application.

    The package is zipped into a temporary file of the driver; ``addPyFile`` serves it to every
    executor, including ones started later, so no shared or remote path is opened here.
    """
    import zipfile
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="claimlens-pkg-")), "claimlens.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
