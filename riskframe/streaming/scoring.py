"""Score incoming applications with Structured Streaming (B4 as a stream).

Scoring is the same stateless projection as batch scoring (the fitted
pipeline's ``transform``), so a file or table stream of raw applications maps
to a stream of ``(id, probability, prediction)`` rows. The file sink plus a
checkpoint location in the shared checkpoint folder gives exactly-once output
that survives a restarted query or lost executors.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..score import Scorer
from ..session import checkpoint_dir
from ..sources.loans import CSV_OPTIONS


def score_stream(scorer: Scorer, stream: DataFrame, threshold: float = 0.5,
                 keep: list[str] | None = None) -> DataFrame:
    """Streaming DataFrame of scores; raises up front if raw inputs are missing."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame (spark.readStream...)")
    return scorer.score(stream, threshold, keep)


def application_stream(spark: SparkSession, path: str, schema: T.StructType,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None
                       ) -> DataFrame:
    """File source of raw applications with a declared schema (never inferred)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS)   # a file whose header differs from the schema raises
    return r.load(path)


def start_scoring(scorer: Scorer, stream: DataFrame, sink_path: str, name: str = "scores",
                  threshold: float = 0.5, available_now: bool = True,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Write scores to Parquet files; the query checkpoint lives in the shared folder."""
    spark = stream.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), f"stream-{name}")
    w = (score_stream(scorer, stream, threshold).writeStream.format("parquet")
         .option("path", sink_path).option("checkpointLocation", ckpt).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.queryName(name).start()
