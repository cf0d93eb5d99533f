"""Sinks.  Stream sinks built on ``foreachBatch`` are idempotent per batch id, so with a checkpoint they are exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.relational import latest_by_key

BatchFunction = Callable[[DataFrame, int], None]


def write_text(df: DataFrame, line: Column, path: str, overwrite: bool = True) -> None:
    """One line of text per row."""
    df.select(line.alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def text_per_batch(line: Column, path: str) -> BatchFunction:
    """Text of each micro-batch under its own folder; a rerun replaces only that folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(line.alias("value")).write.mode("overwrite").text(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def start(
    df: DataFrame, checkpoint: str, mode: str = "append", batch_function: BatchFunction | None = None,
    every_ms: int | None = None, console: bool = False, path: str | None = None, name: str | None = None,
) -> StreamingQuery:
    """Run a stream into a batch function, the console, or parquet files at ``path``.

    With ``every_ms`` it runs on that period; without, it works off what is there and stops.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=f"{every_ms} milliseconds") if every_ms else writer.trigger(availableNow=True)
    if batch_function is not None:
        return writer.foreachBatch(batch_function).start()
    if console:
        return writer.format("console").option("truncate", False).start()
    if path is None:
        raise ValueError("a batch function, the console, or a path is needed")
    return writer.format("parquet").option("path", path).start()


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a table of ``value`` (and ``key``) columns.  Needs Spark's Kafka connector on the class path."""
    messages.write.format("kafka").options(**kafka_options(servers, topic)).save()


def stream_to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    options = kafka_options(servers, topic)
    return messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties)


def merge_statement(table: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Standard MERGE from a stage table: replace rows with equal keys (null equals null), insert the others."""
    rest = [c for c in columns if c not in keys]
    on = " AND ".join(f"(t.{k} = s.{k} OR t.{k} IS NULL AND s.{k} IS NULL)" for k in keys)
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)}" if rest else ""
    return (
        f"MERGE INTO {table} AS t USING {stage} AS s ON {on}{update}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def replace_into_jdbc(
    url: str, table: str, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
    properties: dict[str, str], statement: str | None = None, stage: str | None = None,
) -> BatchFunction:
    """Keyed replace of each micro-batch (or table): newest row per key to a stage table, then one MERGE in the database.

    ``properties`` holds user, password and driver and comes from the caller's secrets.  ``statement`` replaces the MERGE for databases
    with another spelling; ``stage`` names the stage table, and streams into one table need one each.  Repeating a batch leaves the table as it was.
    """
    stage = stage or f"{table}_stage"

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(batch.select(*dict.fromkeys([*columns, *order])), keys, order).select(*columns)
        newest.write.jdbc(url, stage, mode="overwrite", properties=properties)
        jvm = batch.sparkSession._jvm
        info = jvm.java.util.Properties()
        for name, value in properties.items():
            info.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(url, info)
        try:
            connection.createStatement().executeUpdate(statement or merge_statement(table, stage, keys, columns))
        finally:
            connection.close()

    return write
