"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on. Partition sizes are left to
# AQE: it merges small shuffle partitions and splits skewed join partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# For jobs of many writes. An action's shuffle files are deleted when it ends (a later use of the
# same plan computes them again); ids and digests in hex halve under an entropy coder.
LEAN_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}


def build_session(app_name: str = "shelflog", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="shelflog-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/shelflog/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, so several branches
    can scan it (each with its own column pruning) instead of recomputing it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def mount(spark: SparkSession, table: str, **folders: str) -> str:
    """Root of a mount table under which each of ``folders`` appears by its name.

    Paths below the root read and write whatever store the folder lies on, so the parts of a
    warehouse can move to another store without a change of path. The links are Hadoop settings,
    which Spark sends to the executors with every scan and write.
    """
    settings = spark._jsc.hadoopConfiguration()
    for name, folder in folders.items():
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = target.getFileSystem(settings)
        store.mkdirs(target)
        settings.set(f"fs.viewfs.mounttable.{table}.link./{name}", store.makeQualified(target).toString())
    return f"viewfs://{table}"


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """Actions of the block delete their shuffle files when they end and write smaller tables.

    Otherwise shuffle files stay until the driver happens to collect its garbage, so a job of
    many writes holds the shuffles of most of them at once.
    """
    before = {key: spark.conf.get(key, None) for key in LEAN_CONF}
    try:
        for key, value in LEAN_CONF.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def temporary_table(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a written table that is deleted at the end of the block.

    Only for results that are complete by then: nothing lazy may outlive the block.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)
