"""Tables kept as numbered versions, of which exactly one writer makes each.

A version is written to a folder of its own and then moved to ``version=N``, which the file system
refuses if that folder is there already.  On HDFS and local disks the move is atomic and brings the
rows with it, so readers see a version whole or not at all, and of two writers that start from the
same version one has to start again from the other's.  Object stores that copy instead of moving do
not give this; keep such tables on a file system that does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors.exceptions.captured import convert_exception
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

from eventweir.workspace import matching_paths, read_written, remove, write_table


def version_path(path: str, version: int) -> str:
    return f"{path}/version={version}"


def committed(spark: SparkSession, path: str) -> list[int]:
    """The versions below ``path``, those with Spark's marker of a finished write."""
    found = matching_paths(spark, f"{path}/version=*/_SUCCESS")
    return sorted(int(name.split("/")[-2].removeprefix("version=")) for name in found)


def _moved(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder; False if the target is there already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    files = hadoop.FileContext.getFileContext(old.getFileSystem(conf).getUri(), conf)
    never_replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(old, new, never_replace)
    except Py4JJavaError as e:
        if new.getFileSystem(conf).exists(new):
            return False
        raise convert_exception(e.java_exception) from None
    return True


def save_version(df: DataFrame, path: str, version: int) -> bool:
    """Write ``df`` as one version; False, and nothing is kept, if another has written it."""
    spark = df.sparkSession
    if version in committed(spark, path):
        return False
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    write_table(df, draft)
    target = version_path(path, version)
    saved = _moved(spark, draft, target)
    if not saved and version not in committed(spark, path):
        remove(spark, target)  # left by a writer that did not finish, before versions were moved
        saved = _moved(spark, draft, target)
    if not saved:
        remove(spark, draft)
    return saved


def newest(spark: SparkSession, path: str, schema) -> tuple[int, DataFrame | None]:
    """The newest version and its rows; 0 and None if there is none."""
    known = committed(spark, path)
    if not known:
        return 0, None
    return known[-1], read_written(spark, version_path(path, known[-1]), schema)


def update(
    spark: SparkSession, path: str, schema, change: Callable[[DataFrame | None], DataFrame | None]
) -> int:
    """Make the next version out of the newest, again from the start if another writer was first.

    ``change`` gets the newest rows, None if there are none, and gives the new ones, None to leave
    it at that.  Returns the version that holds the change.
    """
    while True:
        version, rows = newest(spark, path, schema)
        changed = change(rows)
        if changed is None:
            return version
        if save_version(changed, path, version + 1):
            return version + 1
