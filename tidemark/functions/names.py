"""Table names that may be used without quoting."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed value: one to three dot-separated identifiers.
TRUSTED_NAME = r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}"
UNSET = " is not a trusted table identifier: it is blank"
REFUSED = " is not a trusted table identifier (up to three plain words joined by dots): "


def is_trusted_name(name: Column) -> Column:
    return F.coalesce(F.rlike(F.trim(name), F.lit(rf"^{TRUSTED_NAME}\z")), F.lit(False))


def untrusted_name_message(name: Column, setting: str) -> Column:
    """Why a name is refused; NULL when it is fine."""
    blank = F.coalesce(F.trim(name), F.lit("")) == ""
    return F.when(blank, F.lit(f"{setting}{UNSET}")).when(~is_trusted_name(name), F.concat(F.lit(f"{setting}{REFUSED}"), name))


def require_trusted_name(name: str | None, setting: str) -> str:
    stripped = (name or "").strip(" ")
    if not stripped:
        raise ValueError(f"{setting}{UNSET}")
    if not re.fullmatch(TRUSTED_NAME, stripped):
        raise ValueError(f"{setting}{REFUSED}{name}")
    return stripped


def optional_trusted_name(name: str | None, setting: str) -> str | None:
    """A blank name means the feature is off."""
    return require_trusted_name(name, setting) if (name or "").strip(" ") else None
