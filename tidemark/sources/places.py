"""Slices of known size, dealt to tasks so that none holds much more than another."""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

#: The task that a row goes to.
PLACE = "_place"


def deal(rows: Mapping[str, int], most: int, tasks: int) -> dict[str, list[int]]:
    """For each slice the tasks that take a part of it, parts of at most ``most`` rows.

    The largest part first, each to the task that has the fewest rows so far; there are ``tasks`` of
    them, or fewer if there are not as many parts.
    """
    parts = [(n / count, name) for name, n in rows.items() for count in [max(1, math.ceil(n / most))] for _ in range(count)]
    free = [(0.0, task) for task in range(min(tasks, len(parts)))]
    places: dict[str, list[int]] = {name: [] for name in rows}
    for size, name in sorted(parts, reverse=True):
        taken, task = heapq.heappop(free)
        places[name].append(task)
        heapq.heappush(free, (taken + size, task))
    return places


def to_places(rows: DataFrame, places: Mapping[str, list[int]], *by: str) -> DataFrame:
    """Rows with a ``_slice`` of ``places``, at the task dealt to their part of it; ``by`` decides on the part."""
    known = rows.sparkSession.createDataFrame(list(places.items()), "_slice string, _tasks array<int>")
    part = F.pmod(F.xxhash64(*by, F.lit("part")), F.size("_tasks")).cast("int")
    placed = rows.join(F.broadcast(known), "_slice").withColumn(PLACE, F.get("_tasks", part)).drop("_tasks")
    return placed.repartitionById(1 + max(max(tasks) for tasks in places.values()), PLACE)
