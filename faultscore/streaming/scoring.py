"""Scoring (I4) over a file stream.

The fitted scorer is row-local (projection, frozen preprocessing SQL,
classifier predict, threshold), so the same plan runs on a ``readStream``
with no state and no watermark.  Progress lives in the checkpoint location,
which the caller names: a query restarted with the same one resumes where it
stopped, and files are scored exactly once in the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.scoring import predict_rows
from ..sources.bundle import Bundle


def scoring_stream(
    rows: DataFrame, bundle: Bundle, keep: list[str] | None = None
) -> DataFrame:
    """A streaming DataFrame of predictions (keys kept)."""
    return predict_rows(bundle.model, bundle.threshold, rows, bundle.feature_columns, keep=keep)


def start_file_scoring(
    spark: SparkSession,
    source: str,
    schema: StructType,
    bundle: Bundle,
    sink: str,
    checkpoint: str,
    keep: list[str] | None = None,
    transform=None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Score parquet files arriving under ``source`` into parquet at ``sink``.

    ``transform`` maps the raw stream to the scorer's input columns (e.g. a
    table adapter).  ``available_now`` processes what is there and stops.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(source)
    rows = transform(raw) if transform else raw
    scored = scoring_stream(rows, bundle, keep)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(sink)
