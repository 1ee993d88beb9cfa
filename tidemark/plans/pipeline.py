"""The stages in their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.plans import gold, silver, upkeep
from tidemark.plans.lake import Lake
from tidemark.streaming.ingest import ingest

STAGES = {
    "bronze": ingest,
    "silver": silver.process,
    "gold": gold.refresh,
    "maintenance": upkeep.run,
}


def run(lake: Lake, stage: str = "all", as_of: Column | None = None) -> dict[str, DataFrame | None]:
    """Run one stage or all of them; each returns its alerts or audit rows."""
    wanted = stage.lower()
    return {
        name: step(lake, as_of=as_of) for name, step in STAGES.items() if wanted in (name, "all")
    }


def follow(lake: Lake, as_of: Column | None = None, **options) -> DataFrame:
    """Ingest, and bring the keyed table up to date after every batch."""
    return ingest(lake, as_of, then=lambda: silver.process(lake, as_of), **options)
