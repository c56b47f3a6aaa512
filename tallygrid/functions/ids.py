"""Content ids of experiments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(text: Column, decoder: Column, mask: Column | None = None) -> Column:
    """SHA-256 over the whole text, the decoder and the mask text, NUL separated.

    A NULL text or decoder counts as empty but keeps its place.
    """
    empty = F.lit("")
    parts = [F.coalesce(c, empty) for c in (text, decoder, empty if mask is None else mask)]
    return F.sha2(F.concat_ws("\u0000", *parts), 256)


def id_prefix(strong_id: Column, length: int = 16) -> Column:
    return F.substring(strong_id, 1, length)
