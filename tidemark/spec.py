"""What the operators need to know about an entity, as plain data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"
INGESTED = "ingest_timestamp"
VIOLATIONS = "validation_errors"
REASON = "rejection_reason"
CATEGORY = "rejection_category"


@dataclass(frozen=True)
class Rule:
    """``violated`` is a SQL predicate over the normalised event.

    ``contract`` names the Contract flag that switches the rule on; a rule
    without one always applies.
    """

    code: str
    category: str
    violated: str
    contract: str | None = None


@dataclass(frozen=True)
class Contract:
    """How strictly events are checked, and which event counts as newer."""

    require_update_time: bool = False
    require_version: bool = False
    # "fallback": an unparsable update time is replaced by the event time
    # "reject":   it is a violation
    bad_update_time: str = "fallback"
    # what orders two events of one batch: "update_time" first or "version" first
    batch_order: str = "update_time"

    @classmethod
    def strict(cls, **changes) -> "Contract":
        return cls(**{"require_update_time": True, "require_version": True, **changes})


@dataclass(frozen=True)
class Entity:
    """Columns of a raw event and the names they take in the keyed table."""

    name: str
    raw: Mapping[str, str]
    key: str
    event_time: str
    update_time: str
    version: str
    measure: str
    date: str
    updated_as: str
    version_as: str
    trimmed: tuple[str, ...]
    blank_as_null: tuple[str, ...]
    formats: tuple[str, ...]
    rules: tuple[Rule, ...]
    count_as: str
    sum_as: str
    parsed_time: str = "parsed_timestamp"
    parsed_update: str = "parsed_updated_at"
    mark: str = INGESTED
    mark_as: str = "source_max_ingest_timestamp"
    refreshed_as: str = "gold_updated_at"
    # columns a raw table may lack, with the type they are filled in with
    optional: Mapping[str, str] = field(
        default_factory=lambda: {RESCUED: "string", CORRUPT: "string", INGESTED: "timestamp"}
    )

    @property
    def raw_schema(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.raw.items())

    @property
    def bronze_schema(self) -> str:
        extra = ", ".join(f"`{name}` {kind}" for name, kind in self.optional.items())
        return f"{self.raw_schema}, {extra}"

    @property
    def state_schema(self) -> str:
        """Schema of the keyed table."""
        raw = [
            (name, "timestamp" if name == self.event_time else kind)
            for name, kind in self.raw.items()
            if name not in (self.update_time, self.version)
        ]
        added = [
            (self.mark, "timestamp"),
            (self.updated_as, "timestamp"),
            (self.version_as, self.raw[self.version]),
            (self.date, "date"),
        ]
        return ", ".join(f"`{name}` {kind}" for name, kind in raw + added)

    @property
    def daily_schema(self) -> str:
        return (
            f"`{self.date}` date, `{self.count_as}` bigint, `{self.sum_as}` double, "
            f"`{self.mark_as}` timestamp, `{self.refreshed_as}` timestamp"
        )

    def newest_first(self, contract: Contract) -> tuple[str, ...]:
        """Columns that order the events of one key, most significant first."""
        lead = (self.updated_as, self.version_as)
        if contract.batch_order == "version":
            lead = lead[::-1]
        return (*lead, self.mark, self.event_time)


# Timestamp formats, tried in this order.
TIME_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    "yyyy-MM-dd'T'HH:mm:ssX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)

# Rejection reasons and their categories.
ORDER_RULES = (
    Rule("MISSING_ORDER_ID", "SCHEMA", "orderId IS NULL OR orderId = ''"),
    Rule("MISSING_CUSTOMER_ID", "SCHEMA", "customerId IS NULL OR customerId = ''"),
    Rule("MISSING_AMOUNT", "SCHEMA", "amount IS NULL"),
    Rule("NON_POSITIVE_AMOUNT", "BUSINESS_RULE", "amount <= 0"),
    Rule("MISSING_TIMESTAMP", "SCHEMA", "timestamp IS NULL OR timestamp = ''"),
    Rule("INVALID_TIMESTAMP", "SCHEMA", "timestamp IS NOT NULL AND parsed_timestamp IS NULL"),
    Rule("MISSING_UPDATED_AT", "SCHEMA", "updatedAt IS NULL", "require_update_time"),
    Rule("INVALID_UPDATED_AT", "SCHEMA", "updatedAt IS NOT NULL AND parsed_updated_at IS NULL"),
    Rule("MISSING_EVENT_VERSION", "SCHEMA", "eventVersion IS NULL", "require_version"),
    Rule("INVALID_EVENT_VERSION", "SCHEMA", "eventVersion < 0"),
    Rule("RESCUED_DATA_PRESENT", "INGESTION", f"{RESCUED} IS NOT NULL"),
    Rule("CORRUPT_RECORD", "INGESTION", f"{CORRUPT} IS NOT NULL"),
)

ORDER_EVENTS = Entity(
    name="orders",
    raw={
        "orderId": "string",
        "customerId": "string",
        "amount": "double",
        "timestamp": "string",
        "updatedAt": "string",
        "eventVersion": "bigint",
    },
    key="orderId",
    event_time="timestamp",
    update_time="updatedAt",
    version="eventVersion",
    measure="amount",
    date="order_date",
    updated_as="updated_at",
    version_as="event_version",
    trimmed=("orderId", "customerId", "timestamp"),
    blank_as_null=("updatedAt",),
    formats=TIME_FORMATS,
    rules=ORDER_RULES,
    count_as="totalOrders",
    sum_as="totalRevenue",
)
