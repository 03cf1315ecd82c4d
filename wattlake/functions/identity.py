"""Deterministic identifiers as native columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F


def uuid5(namespace: uuid.UUID, key: Column) -> Column:
    """Version-5 UUID of a key in a namespace; null for a null key."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(key, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def source_uuid(source: str, key: Column, prefix: str = "https://wattlake.example/") -> Column:
    """Identifier of a record: its key in the namespace of its source."""
    return uuid5(uuid.uuid5(uuid.NAMESPACE_URL, prefix + source), key)
