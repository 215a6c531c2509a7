"""Reading untyped JSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(value: Column, path: str) -> Column:
    """SQL null if the key is absent, a VARIANT null if the key holds a JSON null."""
    return F.try_variant_get(value, path, "variant")
