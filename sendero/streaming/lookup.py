"""New orders looked up by their exact spelling in the variants of known entities, as a stream-static join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_stream(orders: DataFrame, variants: DataFrame, raw: str = "raw") -> DataFrame:
    """A stream of orders with entidad_id; null where the spelling is new."""
    known = variants.select(F.col("variante_original").alias(raw), "entidad_id")
    return orders.join(known, raw, "left")
