"""Daily metrics, and which days have to be computed again."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.sums import BIN_SUMS, COLLECTED, PARTS, total_of, with_limbs
from tidemark.operators.shape import derive_date
from tidemark.spec import Entity

#: What metrics are kept from beside their own columns, so that later changes can be added to them.
ROWS, SUM_PARTS = "_rows", "_sum_parts"
METRIC_STATE = f"{ROWS} bigint, {SUM_PARTS} {PARTS}"
#: Ranges of days that a reader is given; more dates than that share them.
DATE_RANGES = 32


def daily_metrics(state: DataFrame, entity: Entity) -> DataFrame:
    """Count and sum per date.

    The sum is the double nearest to the exact one, however the rows are dealt to tasks: small amounts
    count beside large ones, and a NaN makes its date's sum NaN.
    """
    return _counted(state, entity).select(entity.date, entity.count_as, entity.sum_as)


def daily_metrics_with_mark(
    state: DataFrame, entity: Entity, as_of: Column | None = None
) -> DataFrame:
    """Daily metrics with the newest ingest time they contain."""
    return daily_metrics_with_state(state, entity, as_of).drop(ROWS, SUM_PARTS)


def daily_metrics_with_state(state: DataFrame, entity: Entity, as_of: Column | None = None) -> DataFrame:
    """Daily metrics with their mark, and with what :func:`maintained_metrics` needs to add changes to them."""
    counted = _counted(state, entity, marked=True)
    refreshed = F.current_timestamp() if as_of is None else as_of
    return counted.select(
        entity.date, entity.count_as, entity.sum_as, F.col("mark").alias(entity.mark_as),
        refreshed.alias(entity.refreshed_as), F.col("rows").alias(ROWS), F.col("parts").alias(SUM_PARTS))


def _counted(state: DataFrame, entity: Entity, marked: bool = False) -> DataFrame:
    dated = derive_date(state, entity.date, entity.event_time)
    columns = [entity.date, F.col(entity.key).alias("key"), F.col(entity.measure).alias("measure")]
    if marked:
        columns.append(F.col(entity.mark).alias("mark"))
    return _totals(_per_bin(with_limbs(dated.select(*columns), "measure"), entity, marked), entity, marked)


def _per_bin(limbs: DataFrame, entity: Entity, marked: bool) -> DataFrame:
    """A row per date and bin, added up in each task first; ``limbs`` holds single rows of the table."""
    mark = [F.max("mark").alias("mark")] if marked else []
    sums = [F.expr(sql).alias(name) for name, sql in BIN_SUMS.items()]
    return limbs.groupBy(entity.date, "bin").agg(F.count(F.lit(1)).alias("rows"), F.count("key").alias("keys"), *mark, *sums)


def _totals(binned: DataFrame, entity: Entity, marked: bool) -> DataFrame:
    """A row per date from at most some ninety bins each."""
    mark = [F.max("mark").alias("mark")] if marked else []
    parts = binned.groupBy(entity.date).agg(
        F.sum("rows").alias("rows"), F.sum("keys").alias(entity.count_as), *mark, F.expr(COLLECTED).alias("parts"))
    return parts.withColumn(entity.sum_as, F.expr(total_of("parts")))


def daily_view(spark: SparkSession, state: DataFrame, entity: Entity) -> DataFrame:
    """The same metrics over the whole table, as one SQL query."""
    limbs = with_limbs(state.withColumn("measure", F.col(entity.measure)), "measure")
    sums = ", ".join(f"{sql} AS {name}" for name, sql in BIN_SUMS.items())
    return spark.sql(
        f"""
        SELECT `{entity.date}`,
               SUM(keys) AS `{entity.count_as}`,
               {total_of(COLLECTED)} AS `{entity.sum_as}`,
               MAX(mark) AS `{entity.mark_as}`,
               CURRENT_TIMESTAMP() AS `{entity.refreshed_as}`
        FROM (SELECT `{entity.date}`, bin, COUNT(`{entity.key}`) AS keys, MAX(`{entity.mark}`) AS mark, {sums}
              FROM {{limbs}} GROUP BY `{entity.date}`, bin)
        GROUP BY `{entity.date}`
        """,
        limbs=limbs,
    )


def changes_by_date(changes: DataFrame, entity: Entity, before: dict[str, str]) -> DataFrame:
    """What changed rows add to and take from their dates: a row per date and bin.

    ``changes`` has the rows as they are now; ``before`` names the columns with the date, measure and mark that a
    replaced row had (no date: it is new).  ``gained`` and ``lost`` are the latest marks added and taken away.
    """
    now = changes.select(
        F.col(entity.date), F.col(entity.key).alias("key"), F.col(entity.measure).alias("measure"),
        F.col(entity.mark).alias("mark"), F.lit(1).cast("long").alias("sign"))
    then = changes.filter(F.col(before["date"]).isNotNull()).select(
        F.col(before["date"]).alias(entity.date), F.col(entity.key).alias("key"), F.col(before["measure"]).alias("measure"),
        F.col(before["mark"]).alias("mark"), F.lit(-1).cast("long").alias("sign"))
    limbs = with_limbs(now.unionByName(then), "measure", "sign")
    return limbs.groupBy(entity.date, "bin").agg(
        F.sum("sign").alias("rows"), F.sum(F.when(F.col("key").isNotNull(), F.col("sign")).otherwise(0)).alias("keys"),
        F.max(F.when(F.col("sign") > 0, F.col("mark"))).alias("gained"), F.max(F.when(F.col("sign") < 0, F.col("mark"))).alias("lost"),
        *(F.expr(sql).alias(name) for name, sql in BIN_SUMS.items()))


def maintained_metrics(
    daily: DataFrame, changes: DataFrame, entity: Entity, as_of: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Metrics of the changed dates after the changes, and dates that have to be read again.

    ``daily`` has the columns of :func:`daily_metrics_with_state`, ``changes`` those of :func:`changes_by_date`; no row of
    the keyed table is read.  A date has to be read again if the latest mark was taken from it and no later one came,
    or if its metrics were made before their state was kept.  Dates without rows are left out.
    """
    date = entity.date
    marks = changes.groupBy(date).agg(F.max("gained").alias("gained"), F.max("lost").alias("lost"))
    old = daily.select(
        date, F.col(ROWS).alias("rows"), F.col(entity.count_as).alias("keys"), F.col(entity.mark_as).alias("known"), F.col(SUM_PARTS).alias("parts"))
    judged = marks.join(old.select(F.col(date).alias("of"), "known", F.col("parts").isNotNull().alias("kept")), F.col(date).eqNullSafe(F.col("of")), "left")
    unknown = F.coalesce((F.col("lost") >= F.col("known")) & F.coalesce(F.col("gained") < F.col("known"), F.lit(True)), F.lit(False))
    again = judged.filter(F.col("kept").isNotNull() & (F.col("known").isNull() | unknown | ~F.col("kept"))).select(date)
    touched = marks.select(F.col(date).alias("of"))

    mine = old.join(touched, F.col(date).eqNullSafe(F.col("of")), "left_semi")
    # the counts of a date go with one of its rows
    held = mine.select(date, F.posexplode_outer(F.concat("parts", F.expr(f"CAST(array(named_struct('bin', NULL, 'values', 0, 's0', 0, 's1', 0, 's2', 0, 's3', 0)) AS {PARTS})"))).alias("place", "part"), "rows", "keys", "known", F.size("parts").alias("bins"))
    counts_here = F.col("part.bin").isNull()
    then = held.select(
        date, "part.*", F.when(counts_here, F.col("rows")).otherwise(0).alias("rows"), F.when(counts_here, F.col("keys")).otherwise(0).alias("keys"),
        F.col("known").alias("mark"))
    now = changes.select(date, "bin", "values", "s0", "s1", "s2", "s3", "rows", "keys", F.col("gained").alias("mark"))
    binned = then.unionByName(now).groupBy(date, "bin").agg(
        F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.max("mark").alias("mark"),
        *(F.expr(sql).alias(name) for name, sql in BIN_SUMS.items()))
    # bins that nothing is left of would hide that two ways led to the same sum
    empty = (F.col("values") == 0) & F.col("bin").isNotNull()
    binned = binned.withColumn("bin", F.when(~empty, F.col("bin")))
    totals = _totals(binned, entity, True).filter("rows > 0")
    fresh = totals.select(
        date, entity.count_as, entity.sum_as, F.col("mark").alias(entity.mark_as),
        (F.current_timestamp() if as_of is None else as_of).alias(entity.refreshed_as), F.col("rows").alias(ROWS), F.col("parts").alias(SUM_PARTS))
    return fresh.join(again.select(F.col(date).alias("of")), F.col(date).eqNullSafe(F.col("of")), "left_anti"), again


def high_water_marks(state: DataFrame, entity: Entity) -> DataFrame:
    dated = derive_date(state, entity.date, entity.event_time)
    return dated.groupBy(entity.date).agg(F.max(entity.mark).alias(entity.mark_as))


def affected_dates(
    state: DataFrame, daily: DataFrame | None, entity: Entity, detect: str = "ingest"
) -> DataFrame:
    """Dates whose metrics no longer match the keyed table.

    ``ingest``  new dates, and dates that hold something ingested later than
                their metrics know.
    ``exact``   also dates that lost rows to another date, down to the last one:
                any difference in mark, count or sum, in either direction.

    Without earlier metrics, or without their mark, every date is affected.
    """
    if daily is not None:
        daily = derive_date(daily, entity.date, entity.event_time)
    if daily is None or entity.mark_as not in daily.columns:
        return high_water_marks(state, entity).select(entity.date)

    date, mark, count = entity.date, entity.mark_as, entity.count_as
    if detect == "ingest":
        now = high_water_marks(state, entity).alias("now")
        then = daily.select(date, mark).alias("then")
        return (
            now.join(then, F.col(f"now.{date}") == F.col(f"then.{date}"), "left")
            .filter(F.col(f"then.{date}").isNull() | (F.col(f"now.{mark}") > F.col(f"then.{mark}")))
            .select(f"now.{date}")
        )
    if detect != "exact":
        raise ValueError(f"unknown way to detect affected dates: {detect}")

    now = daily_metrics_with_mark(state, entity).drop(entity.refreshed_as)
    same = F.col(f"now.{date}").eqNullSafe(F.col(f"then.{date}"))
    before, after = F.col(f"then.{entity.sum_as}"), F.col(f"now.{entity.sum_as}")
    differs = (
        F.col("now._seen").isNull()
        | F.col("then._seen").isNull()
        | ~F.col(f"now.{mark}").eqNullSafe(F.col(f"then.{mark}"))
        | ~F.col(f"now.{count}").eqNullSafe(F.col(f"then.{count}"))
        | ~before.eqNullSafe(after)
    )
    now = now.withColumn("_seen", F.lit(True)).alias("now")
    then = daily.select(date, mark, count, entity.sum_as).withColumn("_seen", F.lit(True)).alias("then")
    return (
        now.join(then, same, "full_outer")
        .filter(differs)
        .select(F.coalesce(f"now.{date}", f"then.{date}").alias(date))
    )


def date_ranges(dates: DataFrame, date: str, most: int = DATE_RANGES) -> list[tuple]:
    """At most ``most`` ranges of days that hold all dates, parted at the widest gaps; a null date is in none.

    One row per distinct day is sorted, and one row per range comes to the driver.
    """
    days = dates.select(F.col(date).alias("day")).filter("day IS NOT NULL").distinct()
    ends = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    if ends["first"] is None:
        return []
    gaps = days.withColumn("before", F.lag("day").over(Window.orderBy("day"))).withColumn("gap", F.datediff("day", "before"))
    widest = gaps.filter("gap > 1").orderBy(F.col("gap").desc(), "day").limit(most - 1).collect()
    widest.sort(key=lambda r: r["day"])
    return list(zip([ends["first"], *(r["day"] for r in widest)], [*(r["before"] for r in widest), ends["last"]]))


def in_ranges(date: Column, ranges: list[tuple]) -> Column:
    """Whether a date lies in one of the ranges; as plain comparisons, which readers take."""
    return reduce(or_, (date.between(first, last) for first, last in ranges), F.lit(False))


def restrict_to_dates(state: DataFrame, dates: DataFrame, entity: Entity) -> DataFrame:
    """Rows of the keyed table on the given dates.

    The dates are unique, so a semi join is enough; Spark broadcasts them when
    their size allows and splits a heavy date otherwise.
    """
    dated = derive_date(state, entity.date, entity.event_time)
    return dated.join(dates, entity.date, "left_semi")


def refreshed_metrics(
    state: DataFrame,
    dates: DataFrame,
    entity: Entity,
    as_of: Column | None = None,
) -> DataFrame:
    """Metrics of the given dates only.

    Summing comes first and the semi join second: Spark moves the join below the
    sum when it can broadcast the dates, and otherwise joins a row per date
    instead of moving every order of a heavy date to one task.
    """
    metrics = daily_metrics_with_state(state, entity, as_of)
    return metrics.join(dates, entity.date, "left_semi")


def refresh(
    daily: DataFrame | None,
    state: DataFrame,
    dates: DataFrame,
    entity: Entity,
    drop_empty: bool = False,
    as_of: Column | None = None,
) -> DataFrame:
    """The whole metrics table after recomputing ``dates``.

    ``drop_empty`` removes affected dates that no longer have any row.
    """
    fresh = refreshed_metrics(state, dates, entity, as_of).drop(ROWS, SUM_PARTS)
    if daily is None:
        return fresh
    outdated = dates if drop_empty else fresh.select(entity.date)
    kept = daily.join(outdated, entity.date, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)
