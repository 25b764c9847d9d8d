"""Incremental ingest: new vintage lines as they arrive, with the parser of the batch ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.schemas import TABLES, schema
from ..sources import sinks, vintages


def follow(spark: SparkSession, folder: str, kind: str, into: str, checkpoint: str, dedup_keys: list[str] | None = None) -> StreamingQuery:
    """Appends lines of files that appear in `folder` to the base table of their kind under
    `into`, and malformed ones to <table>_quarantine, by batch; ends when all present files are
    read. A batch that is repeated after a failure replaces its malformed lines and adds nothing to
    the table, which has it as a whole or not at all; dedup_keys: rows whose keys it has go."""
    schema(kind)
    lines = spark.readStream.text(folder)

    def load(batch: DataFrame, number: int) -> None:
        sinks.load_batch(vintages.parse(batch, kind), TABLES[kind], into, number, schema(kind), dedup_keys)
        vintages.quarantine(batch, kind).write.mode("overwrite").parquet(f"{into}/{TABLES[kind]}_quarantine/batch={number}")

    return lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
