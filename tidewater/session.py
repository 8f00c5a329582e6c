"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tidewater") -> SparkSession:
    """Return the active session or build one suitable for local tests.

    On a cluster the session already exists (``getActiveSession``) and its
    configuration is left untouched.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.constraintPropagation.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is read from the session and
    never replaced.  Only in local mode, where all tasks share the machine,
    is a private scratch folder created when it is unset; on a cluster that
    is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: cuts the lineage and survives executor loss like a reliable
    checkpoint, but is encoded by column and keeps columns prunable.  The
    shuffle files of the job are removed as soon as it has written the table;
    else they stay until the driver collects its garbage."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex[:12]}"
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_folders(df: DataFrame) -> set[str]:
    """Folders of the stage tables that ``df`` reads."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    return {f for f in folders if f.rsplit("/", 1)[1].startswith("stage-")}


def next_stage(df: DataFrame, name: str, keep: list[DataFrame]) -> DataFrame:
    """``df`` as a stage table that takes the place of those it was made from:
    the stage tables it read are removed, but for those that ``keep`` reads."""
    read = stage_folders(df) - set().union(*[stage_folders(k) for k in keep])
    out = stage_table(df, name)
    spark = df.sparkSession
    for folder in read:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return out


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Jobs inside drop their shuffle files when they end."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def open_folders(spark: SparkSession, most: int = 100):
    """Writes by partition inside keep up to ``most`` folders open in a task,
    so that the task's rows need no sort; further folders are sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewater`` importable on executors (pandas stages unpickle
    functions from it): zip the package once per SparkContext and
    ``addPyFile`` it, as one ships any library to a cluster."""
    import os
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="tidewater-pkg-"), "tidewater.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))
