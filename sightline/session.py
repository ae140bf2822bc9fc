"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the library's semantics rely on (all instants are UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sightline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session that names none (as in tests) gets a fresh temporary folder. On a cluster
    each executor would write that to its own disk, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sightline-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/sightline/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage at a point that survives the loss of executors, and fixes values that
    would otherwise be computed twice (for example physical partition numbers). With ``tasks``
    no more tasks than that write, each from several partitions: a list much smaller than the
    shuffle's partitions would else cost a file for each of them.
    """
    spark = df.sparkSession
    path = new_scratch(spark, label)
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch = path
    return stored


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def discard(*stored: DataFrame) -> None:
    """Remove the files of :func:`materialize` results that nothing will read again."""
    for df in stored:
        path = getattr(df, "_scratch", None)
        if path is not None:
            remove_folder(df.sparkSession, path)
