"""Gold tables that follow new data without being rebuilt.

The wide table and the summary are partitioned by period of the reading. A refresh finds the periods
that new silver batches touch, and those with facts of engines whose attributes changed: the profile of
the engines is compared, by a digest per engine, with the one of the last refresh. Only the
partitions of these periods are computed and replaced. What a refresh has seen is stored last, in one
step, so one that breaks off is simply done again.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.columns import stamp
from gaugeworks.operators.joins import fits_broadcast, join_reference
from gaugeworks.operators.wide import (
    dated_facts,
    engine_profile,
    fleet_daily_summary,
    known_owners,
)
from gaugeworks.settings import BATCH_COLUMN, GOLD_SUMMARY, GOLD_WIDE, SILVER_TELEMETRY
from gaugeworks.sinks.folds import (
    PLACE_COLUMN,
    Folds,
    drop_partitions,
    folds_of,
    list_batches,
    read_whole,
)
from gaugeworks.sinks.quoting import quoted_text
from gaugeworks.sinks.tables import Namespace
from gaugeworks.sinks.versions import new_version, overwrite, shown_version, versions

PERIOD_COLUMN = "telemetry_period"
FACT_TIME = "telemetry_timestamp"

# Where silver facts are folded to; a condition on the date skips the other partitions.
FACT_PLACE = f"to_date({FACT_TIME})"

_STATE = "gaugeworks.gold"
_DYNAMIC = {"partitionOverwriteMode": "dynamic"}


@dataclass(frozen=True)
class GoldState:
    """What the gold tables hold."""

    period: str
    # Silver batches, as in ``Folds``.
    applied: dict[str, int]
    named: tuple[str, ...]
    # Table with the digest of each engine's attributes.
    profile: str


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: whether in full, and else which periods it replaced."""

    full: bool
    periods: tuple[date | None, ...] = ()


def period_of(day: Column, period: str) -> Column:
    """The first day of the period ("day", "week", "month", "quarter" or "year") of a date."""
    return day if period == "day" else F.trunc(day, period)


def _fact_period(period: str) -> Column:
    return period_of(F.to_date(FACT_TIME), period)


def _is_one_of(column: Column, values: tuple) -> Column:
    known = [value for value in values if value is not None]
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if None in values else found


def profile_digests(profile: DataFrame) -> DataFrame:
    """One digest over all attributes of each engine (engine_id, digest)."""
    body = F.to_json(F.struct(*sorted(profile.columns)), {"ignoreNullFields": "false"})
    return profile.select("engine_id", F.sha2(body, 256).alias("digest"))


def changed_engines(before: DataFrame, after: DataFrame) -> DataFrame:
    """Engines that came, went or have other attributes."""
    old = before.select("engine_id", F.col("digest").alias("old"))
    new = after.select("engine_id", F.col("digest").alias("new"))
    return (
        old.join(new, "engine_id", "full_outer")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select("engine_id")
    )


def gold_state(spark: SparkSession, namespace: Namespace) -> GoldState | None:
    """The state of the gold tables; None if they are not kept by period."""
    stored = shown_version(spark, namespace.gold(GOLD_WIDE))
    if stored is None or not shown_version(spark, namespace.gold(GOLD_SUMMARY)):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {stored}").collect()
    text = {row["key"]: row["value"] for row in rows}.get(_STATE)
    if text is None:
        return None
    state = json.loads(text)
    state = GoldState(**{**state, "named": tuple(state["named"])})
    return state if spark.catalog.tableExists(state.profile) else None


def _store(spark: SparkSession, namespace: Namespace, state: GoldState) -> None:
    stored = shown_version(spark, namespace.gold(GOLD_WIDE))
    text = quoted_text(json.dumps(asdict(state)))
    spark.sql(f"ALTER TABLE {stored} SET TBLPROPERTIES ({quoted_text(_STATE)} = {text})")


def _dimensions(spark: SparkSession, namespace: Namespace) -> list[DataFrame]:
    names = ("engines", "aircraft", "locations")
    return [spark.table(namespace.silver(f"slv_dim_{name}")) for name in names]


def _facts(spark: SparkSession, silver: str, period: str, periods: tuple | None) -> DataFrame:
    """Silver facts, of some periods or of all."""
    facts = read_whole(spark, silver)
    if periods is not None:
        state = folds_of(spark, silver)
        if state and state.place == FACT_PLACE:
            facts = facts.where(_is_one_of(period_of(F.col(PLACE_COLUMN), period), periods))
        facts = facts.where(_is_one_of(_fact_period(period), periods))
        if periods and None not in periods:
            # Bounds that reach the statistics of the files.
            after = datetime.combine(_end(max(periods), period), datetime.min.time())
            first = datetime.combine(min(periods), datetime.min.time())
            facts = facts.where((F.col(FACT_TIME) >= F.lit(first)) & (F.col(FACT_TIME) < F.lit(after)))
    return facts.drop(PLACE_COLUMN)


def _end(start: date, period: str) -> date:
    """A day after the period, at most one period too late."""
    days = {"day": 1, "week": 7, "month": 31, "quarter": 92, "year": 366}[period]
    return start + timedelta(days=days)


def _by_period(dated: DataFrame, period: str) -> DataFrame:
    return (
        dated.withColumn(PERIOD_COLUMN, period_of(F.col("telemetry_date"), period))
        .hint("rebalance", PERIOD_COLUMN)
        .sortWithinPartitions(PERIOD_COLUMN, "engine_id")
    )


def _wide(facts: DataFrame, dimensions: list[DataFrame], period: str) -> DataFrame:
    """The wide rows by period. A broadcast join keeps partitions and order, so it comes after the
    shuffle of the narrow facts; only a profile too large for that is joined before."""
    profile, dated = engine_profile(*dimensions), dated_facts(facts)
    if fits_broadcast(profile):
        placed = _by_period(dated, period)
        wide = join_reference(placed, profile, ["engine_id"], "left", broadcast=True)
        return stamp(wide, "gold_obt_updated_at")
    wide = join_reference(dated, profile, ["engine_id"], "left", broadcast=False)
    return _by_period(stamp(wide, "gold_obt_updated_at"), period)


def _summary(wide: DataFrame, period: str) -> DataFrame:
    summary = fleet_daily_summary(wide)
    return summary.withColumn(PERIOD_COLUMN, period_of(F.col("telemetry_date"), period)).hint(
        "rebalance", PERIOD_COLUMN
    )


def _replace(rows: DataFrame, table: str) -> None:
    """Replace the partitions that ``rows`` have; the tables are made with dynamic overwriting."""
    stored = shown_version(rows.sparkSession, table)
    columns = rows.sparkSession.table(stored).columns
    rows.select(*columns).write.insertInto(stored, overwrite=True)


def refresh_gold(spark: SparkSession, namespace: Namespace, period: str = "day") -> Refreshed:
    """Bring the wide table and the summary up to the silver tables.

    Built in full where they are not kept by this period yet, or where batches were folded before
    gold saw them. Silver facts are not deleted, so no period of the wide table runs empty; one of the
    summary does when its facts are all of unknown owners by now.
    """
    silver, wide, summary = (
        namespace.silver(SILVER_TELEMETRY),
        namespace.gold(GOLD_WIDE),
        namespace.gold(GOLD_SUMMARY),
    )
    dimensions = _dimensions(spark, namespace)
    profile = new_version(f"{wide}__profile")
    profile_digests(engine_profile(*dimensions)).write.saveAsTable(profile)
    batches = list_batches(spark, silver)
    state = gold_state(spark, namespace)
    folded = folds_of(spark, silver) or Folds(FACT_PLACE)
    seen = _seen(state)
    full = (
        state is None
        or state.period != period
        or any(number > seen.applied.get(query, -1) for query, number in folded.applied.items())
        or not set(folded.named) <= set(seen.named)
    )
    if full:
        rows = _wide(_facts(spark, silver, period, None), dimensions, period)
        overwrite(rows, wide, partition_by=[PERIOD_COLUMN], **_DYNAMIC)
        overwrite(
            _summary(spark.table(wide), period), summary, partition_by=[PERIOD_COLUMN], **_DYNAMIC
        )
        result = Refreshed(True)
    else:
        fresh = [batch for batch in batches if not seen.holds(batch)]
        periods = _touched(spark, namespace, period, fresh, state.profile, profile)
        if periods:
            rows = _wide(_facts(spark, silver, period, periods), dimensions, period)
            _replace(rows, wide)
            again = spark.table(wide).where(_is_one_of(F.col(PERIOD_COLUMN), periods))
            filled = known_owners(again).select(PERIOD_COLUMN).distinct().collect()
            _replace(_summary(again, period), summary)
            empty = set(periods) - {row[0] for row in filled}
            specs = [{PERIOD_COLUMN: day and day.isoformat()} for day in empty]
            drop_partitions(spark, shown_version(spark, summary), specs)
        result = Refreshed(False, periods)
    after = _seen(state).with_batches(batches).with_batches(folded.named)
    applied = dict(after.applied)
    for query, number in folded.applied.items():
        applied[query] = max(number, applied.get(query, number))
    _store(spark, namespace, GoldState(period, applied, after.named, profile))
    for old in versions(spark, f"{wide}__profile"):
        if old.lower() < profile.lower():
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return result


def _seen(state: GoldState | None) -> Folds:
    if state is None:
        return Folds(FACT_PLACE)
    return Folds(FACT_PLACE, applied=state.applied, named=state.named)


def _touched(
    spark: SparkSession,
    namespace: Namespace,
    period: str,
    fresh: list[str],
    old_profile: str,
    new_profile: str,
) -> tuple[date | None, ...]:
    """The periods of new facts, and of the facts of changed engines; as many as there are periods."""
    parts = []
    if fresh:
        silver = spark.table(namespace.silver(SILVER_TELEMETRY))
        new = silver.where(F.col(BATCH_COLUMN).isin(fresh))
        parts.append(new.select(_fact_period(period).alias("period")))
    changed = changed_engines(spark.table(old_profile), spark.table(new_profile))
    old = spark.table(namespace.gold(GOLD_WIDE)).join(changed, "engine_id", "left_semi")
    parts.append(old.select(F.col(PERIOD_COLUMN).alias("period")))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    periods = [row.period for row in found.distinct().collect()]
    return tuple(sorted(periods, key=lambda day: (day is None, day or date.min)))
