"""Ingest of raw documents as they arrive: every micro-batch is a load, and loads are idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..operators.store import Store, load
from ..sources.raw import RAW_SCHEMA


def read_stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    """New files of raw documents in a folder."""
    return spark.readStream.schema(RAW_SCHEMA).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)


def start_ingest(stream: DataFrame, config: Config, checkpoint: str, available_now: bool = True):
    """Starts the query; a batch that is run again after a failure finds its documents stored and adds nothing."""

    def one(batch: DataFrame, _: int) -> None:
        load(Store(batch.sparkSession, config.warehouse), batch, config)

    w = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
