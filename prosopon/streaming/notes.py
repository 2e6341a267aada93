"""Streams of texts to partial records. Extraction has no state, so the operators of the batch side serve unchanged; resolution
and fusion need all records and run on the table that the stream fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from prosopon.sources.partials import note_partials


def note_stream(texts: DataFrame) -> DataFrame:
    """texts (streaming): name, text. Partial records of notes."""
    return note_partials(texts.select(F.lit(0).alias("file_ord"), "name", "text")).drop("file_ord", "pos")


def write_stream(partials: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet table, exactly once."""
    return partials.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
