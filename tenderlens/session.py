"""Session settings and the shared scratch area."""

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

# AQE coalesces small shuffles and splits skewed join partitions, also where that costs an extra shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name="tenderlens", master=None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only for a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tenderlens-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tenderlens-{spark.sparkContext.applicationId}"


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """A list of the folders that :func:`scratch_path` names within the block."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    folder = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(folder)
    return f"{folder}/{name}"


def drop_folders(spark: SparkSession, folders: list[str], still_read: DataFrame | None = None) -> list[str]:
    """Delete intermediate folders, but for those that ``still_read`` reads; returns what is left."""
    read = {part for path in (still_read.inputFiles() if still_read is not None else ()) for part in path.split("/")}
    left = [folder for folder in folders if folder.rsplit("/", 1)[-1] in read]
    for folder in set(folders) - set(left):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return left


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; frames built on them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back.

    The table survives executor loss, and its file sizes give the optimizer true
    figures for the joins that follow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def identified(df: DataFrame, key: str, name: str = "_identity") -> DataFrame:
    """``df``, written once, with an id that no two rows share: in the order of ``key``, nulls last.

    Rows of equal or null keys are told apart by their place in the written table.
    """
    own = F.col(f"`{key}`")
    return materialise(df.withColumn(name, F.struct(own.isNull().alias("none"), own.alias("key"), F.monotonically_increasing_id().alias("row"))), "identified")


def spread(table: DataFrame) -> DataFrame:
    """A stored table over all cores, for work that is heavy per row.

    Only a table of fewer splits than cores is shuffled; a large one already has more.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
