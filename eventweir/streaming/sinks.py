"""Streaming sinks.

File sinks are exactly-once through Spark's own commit log.  Micro-batch tables are idempotent:
each batch owns a folder that a replay replaces.  Messages are at-least-once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventweir.streaming.evolving import reconcile_table, stored_schema
from eventweir.workspace import matching_paths, read_written, remove, write_table

AVAILABLE_NOW = {"availableNow": True}
# Fixed value: the trigger interval of the bronze tables.
EVERY_30_SECONDS = {"processingTime": "30 seconds"}

BatchWriter = Callable[[DataFrame, int], None]
_BATCH_COLUMNS = T.StructType(
    [T.StructField("app_id", T.StringType()), T.StructField("batch_id", T.LongType())]
)


MESSAGE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("topic", "key", "value")]
)


def table_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a folder of parquet files.

    A fresh checkpoint is refused where the folder holds batches of another: Spark tells batches by
    their numbers, which start over, and would pass over the new ones as already written.
    """
    _check_numbers(stream.sparkSession, path, checkpoint)
    writer = _writer(stream, checkpoint, name, trigger).format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def catalog_sink(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    trigger: dict | None = None,
    comment: str | None = None,
) -> StreamingQuery:
    """Append a stream to a catalog table, created on first use.

    A table that lacks some of the stream's columns gets them before the stream starts; rows written
    earlier have NULL there.  A column that has changed its type is refused.
    """
    spark = stream.sparkSession
    reconcile_table(spark, table, stream.schema)
    if spark.catalog.tableExists(table):
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        _check_numbers(spark, about.first().data_type, checkpoint)
    writer = _writer(stream, checkpoint, name, trigger).format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.toTable(table)
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    return query


def _check_numbers(spark: SparkSession, path: str, checkpoint: str) -> None:
    if matching_paths(spark, f"{path}/_spark_metadata/*") and not matching_paths(
        spark, f"{checkpoint}/offsets/*"
    ):
        raise ValueError(f"{path} holds batches of another checkpoint than {checkpoint}")


def batch_sink(
    stream: DataFrame,
    process: BatchWriter,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``process(batch, batch_id)``."""
    return _writer(stream, checkpoint, name, trigger).foreachBatch(process).start()


def kafka_sink(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str | None = None,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send a stream of messages; without ``topic`` each row names its own."""
    writer = _writer(messages, checkpoint, name, trigger).format("kafka")
    return writer.options(**kafka_write_options(servers, topic)).start()


def _writer(
    stream: DataFrame, checkpoint: str, name: str | None, trigger: dict | None
) -> DataStreamWriter:
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or EVERY_30_SECONDS))


def kafka_write_options(servers: str, topic: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    if topic is not None:
        options["topic"] = topic
    return options


def kafka_messages(servers: str, topic: str | None = None) -> BatchWriter:
    """A writer of message batches to Kafka."""

    def send(messages: DataFrame, batch_id: int) -> None:
        messages.write.format("kafka").options(**kafka_write_options(servers, topic)).save()

    return send


def file_messages(path: str, app_id: str) -> BatchWriter:
    """A writer of message batches to files, for use without a broker."""

    def send(messages: DataFrame, batch_id: int) -> None:
        replace_batch(messages, path, app_id, batch_id)

    return send


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages written by ``file_messages``."""
    return read_batches(spark, path, MESSAGE_SCHEMA)


def batch_path(path: str, app_id: str, batch_id: int) -> str:
    return f"{path}/app_id={app_id}/batch_id={batch_id}"


def replace_batch(
    batch: DataFrame, path: str, app_id: str, batch_id: int, partition_by: Sequence[str] = ()
) -> None:
    """Write a micro-batch to the folder it owns.

    A replayed batch replaces the whole folder, also where it now takes other routes than before.
    Give a new ``app_id`` when a checkpoint is discarded: batch numbers then start over.
    """
    write_table(batch, batch_path(path, app_id, batch_id), partition_by)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """The table written by ``replace_batch``, without its bookkeeping columns.

    Only batches whose write has finished are read, so one that is being written or replaced is seen
    whole or not at all.  Batches that ``compact_batches`` has packed are read from there.  Without a
    schema the table is read by the one that ``payload_flow`` keeps beside it.
    """
    schema = schema or stored_schema(spark, path)
    packed = packed_batches(spark, path)
    table = _read_folders(spark, path, schema, finished_batches(spark, path, packed))
    for app_id, last in packed.items():
        table = table.unionByName(read_written(spark, _packed_path(path, app_id, last), schema))
    return table


def finished_batches(
    spark: SparkSession, path: str, packed: dict[str, int] | None = None
) -> list[str]:
    """The folders of the batches whose write has finished and that are not packed."""
    found = []
    for marker in matching_paths(spark, f"{path}/app_id=*/batch_id=*/_SUCCESS"):
        app_id, number = (part.split("=", 1)[1] for part in marker.split("/")[-3:-1])
        if int(number) > (packed or {}).get(app_id, -1):
            found.append(marker.removesuffix("/_SUCCESS"))
    return found


def _read_folders(
    spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[str]
) -> DataFrame:
    """Some batches' rows; ``compact_batches`` keeps their number small."""
    if not folders:
        return spark.createDataFrame([], schema)
    full = T.StructType(schema.fields + _BATCH_COLUMNS.fields)
    table = spark.read.schema(full).option("basePath", path).parquet(*folders)
    return table.drop("app_id", "batch_id")


PACKED = "_packed"


def _packed_path(path: str, app_id: str, last: int) -> str:
    return f"{path}/{PACKED}/app_id={app_id}/last={last}"


def packed_batches(spark: SparkSession, path: str) -> dict[str, int]:
    """By ``app_id`` the last batch that is packed; only finished rewrites count."""
    last: dict[str, int] = {}
    for found in matching_paths(spark, f"{path}/{PACKED}/app_id=*/last=*/_SUCCESS"):
        app_id, number = found.split("/")[-3:-1]
        app_id, number = app_id.removeprefix("app_id="), int(number.removeprefix("last="))
        last[app_id] = max(number, last.get(app_id, -1))
    return last


def compact_batches(
    spark: SparkSession,
    path: str,
    app_id: str,
    last: int,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Rewrite an application's batches up to ``last`` as few large files and delete them.

    ``last`` has to be a batch that the stream has committed.  The marker of the finished write is
    the switch: before it readers take the batches, after it the rewrite, and at no time both.  A
    packed batch that is replayed is not read again.  So a table has a folder per route and outcome
    and those of the batches since; run it as a batch job beside the stream.
    """
    schema = schema or stored_schema(spark, path)
    before = packed_batches(spark, path).get(app_id, -1)
    if last <= before:
        return
    folders = [
        folder
        for folder in finished_batches(spark, path, {app_id: before})
        if f"/app_id={app_id}/" in f"{folder}/" and int(folder.rsplit("=", 1)[1]) <= last
    ]
    table = _read_folders(spark, path, schema, folders)
    if before >= 0:
        table = table.unionByName(read_written(spark, _packed_path(path, app_id, before), schema))
    write_table(table, _packed_path(path, app_id, last), partition_by, packed=bool(partition_by))
    for folder in matching_paths(spark, f"{path}/app_id={app_id}/batch_id=*"):
        if int(folder.rsplit("=", 1)[1]) <= last:
            remove(spark, folder)
    if before >= 0:
        remove(spark, _packed_path(path, app_id, before))


def compact(table: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite a table of many small files to ``path``, as a batch job."""
    write_table(table, path, partition_by, packed=True)
