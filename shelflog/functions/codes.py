"""Standardising free-text codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def std_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def code_or_default(code: Column, default: str) -> Column:
    """Standardised code; null and blank text become ``default``."""
    return F.coalesce(F.nullif(std_code(code), F.lit("")), F.lit(default))


def one_of(code: Column, accepted: list[str], otherwise: str = "UNKNOWN") -> Column:
    """Standardised code if accepted; anything else, null included, is ``otherwise``."""
    return F.when(std_code(code).isin(accepted), std_code(code)).otherwise(F.lit(otherwise))
