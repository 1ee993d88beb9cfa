"""Checking events against a contract, and what happens to those that fail."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import trimmed, trimmed_or_null
from tidemark.functions.times import parse_any
from tidemark.operators.shape import backfill_columns
from tidemark.spec import CATEGORY, CORRUPT, REASON, RESCUED, VIOLATIONS, Contract, Entity, Rule


def normalise(events: DataFrame, entity: Entity) -> DataFrame:
    """Fill in missing columns and clean the text ones."""
    may_lack = {
        **entity.optional,
        entity.update_time: entity.raw[entity.update_time],
        entity.version: entity.raw[entity.version],
    }
    cleaned = {name: trimmed(F.col(name)) for name in entity.trimmed}
    cleaned |= {name: trimmed_or_null(F.col(name)) for name in entity.blank_as_null}
    return backfill_columns(events, may_lack).withColumns(cleaned)


def with_parsed_times(events: DataFrame, entity: Entity, contract: Contract) -> DataFrame:
    """Both times as timestamps.

    The one-row ``inline`` keeps the parsing in one place: Spark would otherwise
    copy the expressions into every filter it moves below them, and parse each
    text several times.
    """
    parsed = F.struct(
        parse_any(F.col(entity.event_time), entity.formats).alias(entity.parsed_time),
        parse_any(F.col(entity.update_time), entity.formats).alias(entity.parsed_update),
    )
    events = events.select("*", F.inline(F.array(parsed)))
    if contract.require_update_time:
        return events
    stated, happened = F.col(entity.parsed_update), F.col(entity.parsed_time)
    if contract.bad_update_time == "reject":
        updated = F.when(F.col(entity.update_time).isNull(), happened).otherwise(stated)
    else:
        updated = F.coalesce(stated, happened)
    return events.withColumn(entity.parsed_update, updated)


def rules_in_force(rules: Iterable[Rule], contract: Contract) -> list[Rule]:
    return [r for r in rules if r.contract is None or getattr(contract, r.contract)]


def violations(rules: Iterable[Rule]) -> Column:
    """Codes of all violated rules, in rule order.

    Removing blanks instead of NULLs keeps the expression in generated code.
    """
    fired = [f"CASE WHEN {rule.violated} THEN '{rule.code}' ELSE '' END" for rule in rules]
    return F.expr(f"array_remove(array({', '.join(fired)}), '')")


def validate(events: DataFrame, entity: Entity, contract: Contract = Contract()) -> DataFrame:
    """Every event, cleaned and parsed, with the codes of the rules it violates."""
    checked = with_parsed_times(normalise(events, entity), entity, contract)
    return checked.withColumn(VIOLATIONS, violations(rules_in_force(entity.rules, contract)))


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size(VIOLATIONS) > 0)


def accepted(validated: DataFrame, entity: Entity) -> DataFrame:
    """Events without violations, in the columns of the keyed table."""
    passed = validated.filter(
        (F.size(VIOLATIONS) == 0)
        & F.col(entity.parsed_time).isNotNull()
        & F.col(entity.parsed_update).isNotNull()
    )
    renamed = {
        entity.event_time: F.col(entity.parsed_time),
        entity.updated_as: F.col(entity.parsed_update),
        entity.version_as: F.col(entity.version),
        entity.date: F.to_date(entity.parsed_time),
    }
    return passed.withColumns(renamed).drop(
        VIOLATIONS,
        entity.parsed_time,
        entity.parsed_update,
        RESCUED,
        CORRUPT,
        entity.update_time,
        entity.version,
    )


def clean(events: DataFrame, entity: Entity, contract: Contract = Contract()) -> DataFrame:
    return accepted(validate(events, entity, contract), entity)


def was_rescued() -> Column:
    """The reader already had trouble with the record."""
    return F.col(RESCUED).isNotNull() | F.col(CORRUPT).isNotNull()


def category_of(reason: Column, rules: Iterable[Rule]) -> Column:
    by_category: dict[str, list[str]] = {}
    for rule in rules:
        by_category.setdefault(rule.category, []).append(rule.code)
    result = F
    for category, codes in by_category.items():
        result = result.when(reason.isin(codes), F.lit(category))
    return result.otherwise(F.lit("UNKNOWN"))


def rejections(rejected_events: DataFrame, entity: Entity, as_of: Column | None = None) -> DataFrame:
    """One row per rejected event and reason, holding the cleaned values."""
    return (
        rejected_events.withColumn(REASON, F.explode(VIOLATIONS))
        .withColumn(CATEGORY, category_of(F.col(REASON), entity.rules))
        .withColumn("quarantined_at", F.current_timestamp() if as_of is None else as_of)
        .drop(VIOLATIONS, entity.parsed_time, entity.parsed_update)
    )


def quality_counters(validated: DataFrame, *by: str) -> DataFrame:
    """All counts of a validation run in one pass, overall or per group."""
    return validated.groupBy(*by).agg(*quality_counts())


def quality_counts() -> list[Column]:
    """The counts of a validation run; also to be counted while its rows are written."""
    reasons = F.size(VIOLATIONS)
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(reasons > 0).alias("bad_records"),
        F.count_if((reasons > 0) & was_rescued()).alias("rescued_records"),
        F.count_if(reasons == 0).alias("clean_records"),
        F.coalesce(F.sum(reasons), F.lit(0)).cast("bigint").alias("quarantine_rows"),
    ]


def quarantine_summary(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(CATEGORY, REASON)
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), CATEGORY, REASON)
    )
