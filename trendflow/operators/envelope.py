"""Ingest envelope and landing partition columns for raw payload documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendflow.config import (
    INGEST_DATE_FORMAT, INGEST_HOUR_FORMAT, INGEST_ID_FORMAT, PAYLOAD_SOURCE,
)
from trendflow.functions.coerce import as_col, normalise_region


def attach_envelope(docs: DataFrame, ingested_at: Column | str, region: Column | str,
                    items: str = "items", count_items: bool = True,
                    source: str = PAYLOAD_SOURCE) -> DataFrame:
    """P21 + P22: add ``_pipeline_metadata`` and the landing partition
    columns (``region``, ``date`` yyyy-MM-dd, ``hour`` HH) to each document.

    ingestion_id is the stamp as yyyyMMdd_HHmmss; video_count is the number
    of items (statistics pages only, ``count_items=False`` for category
    documents); the region is trimmed and lower-cased.
    """
    at = as_col(ingested_at)
    reg = normalise_region(region)
    meta = [
        F.date_format(at, INGEST_ID_FORMAT).alias("ingestion_id"),
        reg.alias("region"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_timestamp"),
    ]
    if count_items:
        meta.append(F.coalesce(F.size(items), F.lit(0)).cast("bigint").alias("video_count"))
    meta.append(F.lit(source).alias("source"))
    return docs.withColumns({
        "_pipeline_metadata": F.struct(*meta),
        "region": reg,
        "date": F.date_format(at, INGEST_DATE_FORMAT),
        "hour": F.date_format(at, INGEST_HOUR_FORMAT),
    })
