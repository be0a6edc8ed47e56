"""The shared folder for written intermediate tables and stream checkpoints."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, the same rule for every master.

    Where that is unset, a folder below the session's warehouse, where Spark keeps its own tables.
    On a cluster, a warehouse on the driver's own disk is refused: executors do not see it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    if warehouse.startswith("file:") and not re.match(r"local(\[|$)", master):
        raise ValueError(f"on {master} set {CHECKPOINT_CONF}: {warehouse} is one machine's own")
    return warehouse + "/_eventweir"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table or folder, in whatever store it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The files and folders that a pattern matches, in whatever store they lie."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in files.globStatus(target) or [])


def discard(spark: SparkSession) -> None:
    """Delete every intermediate table this application has written.

    DataFrames that still read one of them fail afterwards; call it when their results are stored.
    """
    remove(spark, f"{shared_dir(spark)}/eventweir/{spark.sparkContext.applicationId}")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/eventweir/{app}/{name}-{uuid.uuid4().hex}"


def materialise(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    packed: bool = False,
    folders: int = 0,
) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage for good: losing executors later costs a re-read, not a recomputation, and
    values from non-deterministic expressions no longer change between uses.
    """
    return write_table(df, fresh_path(df.sparkSession, name), partition_by, packed, folders)


WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession, folders: int):
    """Let tasks keep a file open for each of so many folders while a table is written."""
    before = spark.conf.get(WRITERS_CONF)
    if folders:
        spark.conf.set(WRITERS_CONF, folders)
    try:
        yield
    finally:
        spark.conf.set(WRITERS_CONF, before)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    packed: bool = False,
    folders: int = 0,
) -> DataFrame:
    """Write ``df`` as the whole content of ``path`` and return the written table.

    Replaces what is there, also in sessions set to overwrite only the partitions written to.
    Spark sorts the rows of a task by their folder first; where the number of ``folders`` is known
    to be small, naming it spares that sort.  Tasks that meet more of them go back to sorting.
    """
    rows = pack(df, partition_by) if packed else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with _open_files(df.sparkSession, folders):
        writer.partitionBy(*partition_by).parquet(path)
    return read_written(df.sparkSession, path, df.schema)


def pack(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a folder together before a partitioned write.

    Without it every task writes one file per folder it meets: no shuffle, the better choice for a
    dozen folders and input splits of a gigabyte.  With hundreds of folders, or to rewrite many
    small files, this adds one shuffle whose partitions are sized at run time by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: small folders become one file, a folder
    that holds most of the rows is spread over many tasks.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("packing needs spark.sql.adaptive.enabled to split hot folders")
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def read_written(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read parquet back with the schema it was written with.

    Giving the schema spares the footer scan and keeps partition values as text: event types that
    look like numbers or dates are not re-typed.
    """
    return spark.read.schema(schema).parquet(path)
