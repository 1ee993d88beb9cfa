"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(text: Column) -> Column:
    """Strip spaces (only spaces: a tab is content)."""
    return F.trim(text)


def trimmed_or_null(text: Column) -> Column:
    """Strip spaces; nothing left counts as missing."""
    return F.nullif(F.trim(text), F.lit(""))
