"""Reading error messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Phrases that point at missing rights.
PERMISSION_PHRASES = (
    "permission",
    "not authorized",
    "unauthorized",
    "access denied",
    "insufficient privileges",
)


def is_permission_failure(message: Column) -> Column:
    found = F.rlike(F.lower(message), F.lit("|".join(PERMISSION_PHRASES)))
    return F.coalesce(found, F.lit(False))
