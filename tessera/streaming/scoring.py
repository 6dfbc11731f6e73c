"""Stateless operators on a stream.

The reference has no streams; what carries over is that every fitted
projection (scalers T2, linear / logistic scores M1 / M2, thresholds P5 / P6,
centroid assignment K1, densities N2, dense layers R1) holds no state, so the
same function that scores a batch DataFrame scores a streaming one.  The
sink's checkpoint lives in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


def read_parquet_stream(spark: SparkSession, directory: str, schema: StructType, file_glob: str | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], out_path: str,
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Apply a stateless ``scorer`` (DataFrame -> DataFrame) to every micro-batch
    and append the result as parquet.  ``available_now`` processes what is
    there and stops (a batch-like run that restarts from the checkpoint)."""
    spark = stream.sparkSession
    ckpt = checkpoint or ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{uuid.uuid4().hex}"
    w = scorer(stream).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ckpt)
    w = w.outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
