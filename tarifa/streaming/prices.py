"""Pricing of a request stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tarifa.operators.pricing import price_batch


def price_stream(
    requests: DataFrame,
    output: str,
    checkpoint: str,
    keep: list[str] | None = None,
    pricing: Callable[..., DataFrame] = price_batch,
) -> StreamingQuery:
    """Price the requests that are available and append the results to ``output``. Stateless."""
    return (
        pricing(requests, keep)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
