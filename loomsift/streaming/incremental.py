"""Incremental scoring: only files that came since the last run, with progress kept in a checkpoint."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomsift.config import EngineConfig
from loomsift.functions.text import decode_utf8
from loomsift.operators.quality import quality


def score_new_files(spark: SparkSession, folder: str, out: str, checkpoint: str, pattern: str = "*.txt", words: list[str] | None = None, config: EngineConfig = EngineConfig()) -> StreamingQuery:
    """Score what is new in the folder, append records to ``out``, and stop; run it again to go on.

    Files without bytes are passed over, as the streaming source does not give them out.
    """
    schema = spark.read.format("binaryFile").load(folder).schema
    src = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).load(folder)
    texts = src.select(F.element_at(F.split("path", "/"), -1).alias("name"), decode_utf8("content").alias("text"))
    scored = quality(texts, "text", words, config).drop("component_results")
    return scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
