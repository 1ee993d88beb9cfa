"""tidemark: Spark pipelines over mutable, keyed business events.

Raw events are ingested once, checked against a contract, reduced to the newest
state per key, merged into a keyed table and summed up per day.  Every operator
takes DataFrames and returns a DataFrame; reading and writing happen in
``tidemark.plans`` and ``tidemark.streaming``.
"""

from tidemark.spec import Contract, Entity, ORDER_EVENTS, Rule

__all__ = ["Contract", "Entity", "ORDER_EVENTS", "Rule"]
