"""Timestamps written in several formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# What the text of each numeric field looks like.  Wider than Spark's reading on
# purpose: a guard may let a bad text through, never hold a good one back.
_FIELD_TEXT = {
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"\d\d",
    "dd": r"\d\d",
    "HH": r"\d\d",
    "mm": r"\d\d",
    "ss": r"\d\d",
    "SSS": r"\d{1,3}",
    "X": r"(Z|[+-]\d{2,4})",
}
_FIELD = re.compile("|".join(sorted(_FIELD_TEXT, key=len, reverse=True)))


# Formats of this family, written with four-digit years and a plain Z, are also
# what Spark's much faster cast reads, with the same result.
_ISO_FAMILY = re.compile(r"yyyy-MM-dd(('T'| )HH:mm:ss(\.SSS)?X?)?")
_ISO_TEXT = {**_FIELD_TEXT, "yyyy": r"\d{4}", "X": "Z"}


def parse_any(text: Column, formats: Sequence[str]) -> Column:
    """The first format that reads the text; NULL when none does.

    Text in plain ISO form is cast.  Anything else goes through the formats one
    by one; a failed attempt costs an exception inside Spark, so a format is only
    tried on text of its shape.
    """
    attempts = []
    for pattern in formats:
        parsed = F.try_to_timestamp(text, F.lit(pattern))
        shape = _shape(pattern, _FIELD_TEXT)
        attempts.append(F.when(F.rlike(text, F.lit(f"(?i)^{shape}\\z")), parsed) if shape else parsed)
    one_by_one = F.coalesce(*attempts)

    iso = [_shape(p, _ISO_TEXT) for p in formats if _ISO_FAMILY.fullmatch(p)]
    if not iso:
        return one_by_one
    is_iso = F.rlike(text, F.lit(f"^({'|'.join(iso)})\\z"))
    return F.when(is_iso, text.try_cast("timestamp")).otherwise(one_by_one)


def _shape(pattern: str, field_text: dict[str, str]) -> str | None:
    """A regular expression for texts of the pattern; None when it has unusual parts."""
    plain = pattern.replace("'", "")
    pieces, end = [], 0
    for match in _FIELD.finditer(plain):
        pieces += [plain[end : match.start()], match.group()]
        end = match.end()
    pieces.append(plain[end:])
    if any(set(separator) - set("T-: ./") for separator in pieces[::2]):
        return None  # month names and the like
    return "".join(
        field_text[piece] if i % 2 else re.escape(piece) for i, piece in enumerate(pieces)
    )
