"""Small frames used by several tests."""

from __future__ import annotations

import json

from tidemark.spec import ORDER_EVENTS

RAW = ORDER_EVENTS.raw_schema


def events(spark, *rows, rescued=None):
    """Raw events given as (id, customer, amount, timestamp, updatedAt, version)."""
    return spark.createDataFrame(list(rows), RAW)


def as_json(row) -> str:
    return json.dumps(dict(zip(ORDER_EVENTS.raw, row)))


def write_lines(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else as_json(r) for r in rows)
    (folder / name).write_text(text + "\n")


def write_array(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    body = [dict(zip(ORDER_EVENTS.raw, r)) if isinstance(r, tuple) else r for r in rows]
    (folder / name).write_text(json.dumps(body, indent=2))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
