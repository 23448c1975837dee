"""Landed response pages as a stream: each file once, whatever fails between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from legispark.sources.scan import flatten_envelope


def pages(spark: SparkSession, folder: str, body: str = "body", key: Sequence[str] = ("bill_id", "fetched_at")) -> DataFrame:
    """Files of JSON lines with the requested key, a time and the page's body as they land."""
    schema = ", ".join([*(f"{k} {'timestamp' if k == 'fetched_at' else 'string'}" for k in key), f"{body} string"])
    return spark.readStream.schema(schema).json(folder)


def land(spark: SparkSession, folder: str, out: str, checkpoint: str, endpoint: str, fields: Sequence[str], unique: Sequence[str], late: str = "7 days") -> StreamingQuery:
    """Flattens what has landed and appends it to out, then stops; the checkpoint tells where to go on.

    Rows that repeat the unique fields within the watermark are dropped; its state goes with time.
    """
    rows = flatten_envelope(pages(spark, folder), "body", endpoint, ["bill_id", "fetched_at"], fields)
    rows = rows.withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(list(unique))
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
