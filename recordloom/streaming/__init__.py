"""Row-local normalisation of a stream of records; nothing else of the engine needs a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordloom.functions.text import normalised


def normalise_stream(records: DataFrame) -> DataFrame:
    """``records`` from readStream with the normalised columns; no state, no watermark."""
    return normalised(records)
