"""Folding of batch-written tables: micro-batches become a few sorted runs.

A table that is written batch by batch gains a partition per micro-batch. Folding moves batches that
every stream over the table has taken into runs of a second table, partitioned by a place (a date,
say, or a bucket of the key), so that the partitions no longer grow with the batches. Runs are kept in
levels: a new run takes in all smaller runs until each one is larger than all that are smaller
together. So there are few runs, each row is rewritten a logarithmic number of times, and where
rows of a key replace each other all runs together hold less than twice the rows of the largest.

One view holds what is whole: the runs that count, and which batches are in them. Replacing the view is
a single catalog operation, so a fold that breaks off anywhere leaves rows neither lost nor doubled;
the next one removes what it left. A micro-batch that is replayed after it was folded is known by its
query and number and is not written again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.settings import BATCH_COLUMN
from gaugeworks.sinks.quoting import quoted_name, quoted_text, sql_type

RUN_COLUMN = "_run"
PLACE_COLUMN = "_place"

_STATE = "gaugeworks.folds"

# How a listing shows a NULL.
_NO_VALUE = ("null", "__HIVE_DEFAULT_PARTITION__")
# Partitions dropped by one statement.
_AT_ONCE = 500

# A micro-batch of a stream: the id of its query, and its number.
_NUMBERED = re.compile(r"(.+)-(\d+)")


@dataclass(frozen=True)
class Folds:
    """What a folded table consists of beside its batches."""

    # SQL text of the place of a row.
    place: str
    # Rows of each run.
    runs: dict[str, int] = field(default_factory=dict)
    # By query, the number up to which all batches are folded.
    applied: dict[str, int] = field(default_factory=dict)
    # Folded batches whose names have no number.
    named: tuple[str, ...] = ()

    def holds(self, batch: str) -> bool:
        numbered = _NUMBERED.fullmatch(batch)
        if numbered and numbered[1] in self.applied:
            return int(numbered[2]) <= self.applied[numbered[1]]
        return batch in self.named

    def with_batches(self, batches: Sequence[str]) -> Folds:
        applied, named = dict(self.applied), set(self.named)
        for batch in batches:
            if numbered := _NUMBERED.fullmatch(batch):
                query, number = numbered[1], int(numbered[2])
                applied[query] = max(number, applied.get(query, number))
            else:
                named.add(batch)
        return replace(self, applied=applied, named=tuple(sorted(named)))

    def unfolded(self) -> str:
        """SQL condition on the batch column: the batch is in no run."""
        name = quoted_name(BATCH_COLUMN)
        parts = [f"{name} NOT IN ({', '.join(map(quoted_text, self.named))})"] if self.named else []
        for query, number in sorted(self.applied.items()):
            start = quoted_text(f"{query}-")
            rest = f"TRY_CAST(substring({name}, {len(query) + 2}) AS BIGINT)"
            parts.append(f"NOT (startswith({name}, {start}) AND coalesce({rest} <= {number}, false))")
        return " AND ".join(parts) or "true"


def runs_table(table: str) -> str:
    return f"{table}__runs"


def whole_view(table: str) -> str:
    return f"{table}__whole"


def folds_of(spark: SparkSession, table: str) -> Folds | None:
    """The state of a folded table; None if it was never folded."""
    view = whole_view(table)
    if not spark.catalog.tableExists(view):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {view}").collect()
    state = json.loads({row["key"]: row["value"] for row in rows}[_STATE])
    return Folds(**{**state, "named": tuple(state["named"])})


def is_folded(spark: SparkSession, table: str, batch: str) -> bool:
    state = folds_of(spark, table)
    return state is not None and state.holds(batch)


def list_batches(spark: SparkSession, table: str) -> list[str]:
    """The batches that have a partition; empty if there is no table."""
    if not spark.catalog.tableExists(table):
        return []
    return sorted(spec[BATCH_COLUMN] for spec in _partitions(spark, table))


def _partitions(spark: SparkSession, table: str) -> list[dict[str, str | None]]:
    """The partitions by column; a listing has their values with escapes, and a name for NULL."""
    specs = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = (part.split("=", 1) for part in row[0].split("/"))
        specs.append({k: None if v in _NO_VALUE else unquote(v) for k, v in parts})
    return specs


def read_whole(spark: SparkSession, table: str) -> DataFrame:
    """All rows, folded or not, with their place if the table was folded.

    A condition on the place column skips the runs' partitions of other places.
    """
    view = whole_view(table)
    if spark.catalog.tableExists(view):
        return spark.table(view)
    return spark.table(table).drop(BATCH_COLUMN)


def _columns(spark: SparkSession, table: str) -> list:
    return [f for f in spark.table(table).schema if f.name != BATCH_COLUMN]


def _show(spark: SparkSession, table: str, state: Folds) -> None:
    """Make a state the one that readers see."""
    names = ", ".join(quoted_name(f.name) for f in _columns(spark, table))
    place = quoted_name(PLACE_COLUMN)
    live = f"SELECT {names}, {state.place} AS {place} FROM {table} WHERE {state.unfolded()}"
    runs = ", ".join(map(quoted_text, state.runs)) or "''"
    stored = f"SELECT {names}, {place} FROM {runs_table(table)} WHERE {RUN_COLUMN} IN ({runs})"
    text = quoted_text(json.dumps(asdict(state)))
    spark.sql(
        f"CREATE OR REPLACE VIEW {whole_view(table)} TBLPROPERTIES ({quoted_text(_STATE)} = {text}) "
        f"AS {stored} UNION ALL {live}"
    )


def _fit_runs(spark: SparkSession, table: str, state: Folds) -> None:
    """The table of runs with all columns of the batch table."""
    runs = runs_table(table)
    fields = _columns(spark, table)
    if not spark.catalog.tableExists(runs):
        place = spark.table(table).selectExpr(f"{state.place} AS {PLACE_COLUMN}").schema[0]
        columns = ", ".join(f"{quoted_name(f.name)} {sql_type(f.dataType)}" for f in fields)
        spark.sql(
            f"CREATE TABLE {runs} ({columns}, {RUN_COLUMN} STRING, "
            f"{PLACE_COLUMN} {sql_type(place.dataType)}) USING parquet "
            f"PARTITIONED BY ({RUN_COLUMN}, {PLACE_COLUMN})"
        )
        return
    present = {name.lower() for name in spark.table(runs).columns}
    missing = [f for f in fields if f.name.lower() not in present]
    if missing:
        columns = ", ".join(f"{quoted_name(f.name)} {sql_type(f.dataType)}" for f in missing)
        spark.sql(f"ALTER TABLE {runs} ADD COLUMNS ({columns})")


def refresh(spark: SparkSession, table: str) -> None:
    """Show columns that the batch table gained since the last fold."""
    state = folds_of(spark, table)
    if state is not None:
        _fit_runs(spark, table, state)
        _show(spark, table, state)


def fold_batches(
    spark: SparkSession,
    table: str,
    place: str,
    batches: Sequence[str] | None = None,
    shed: Callable[[DataFrame], DataFrame] | None = None,
    sort: Sequence[str] = (),
) -> Folds:
    """Move batches of ``table`` into its runs; ``place`` is SQL for the partition of a row.

    ``batches`` must have been taken by every stream over the table: list them before those streams
    are drained. By default all are folded. Of one query the earlier batches go along. ``shed`` drops
    rows that others replace, over the rows of a run. Rows are rebalanced by place, which splits a
    place that holds a large share, and sorted by ``sort`` in each file.
    """
    state = folds_of(spark, table) or Folds(place)
    if state.place != place:
        raise ValueError(f"{table} is folded by {state.place}, not by {place}")
    if not spark.catalog.tableExists(table):
        return state
    tidy(spark, table, state)
    there = list_batches(spark, table)
    after = state.with_batches(there if batches is None else batches)
    taken = [batch for batch in there if after.holds(batch)]
    if not taken:
        return state
    _fit_runs(spark, table, state)
    names = [quoted_name(f.name) for f in _columns(spark, table)]
    fresh = spark.table(table).where(F.col(BATCH_COLUMN).isin(taken))
    merged = _merged(state.runs, fresh.count())
    rows = fresh.selectExpr(*names)
    if merged:
        older = spark.table(runs_table(table)).where(F.col(RUN_COLUMN).isin(merged))
        rows = older.selectExpr(*names).unionByName(rows)
    if shed:
        rows = shed(rows).selectExpr(*names)
    placed = rows.selectExpr("*", f"{place} AS {PLACE_COLUMN}").hint("rebalance", PLACE_COLUMN)
    run = uuid.uuid4().hex
    spark.sql(
        f"INSERT INTO TABLE {runs_table(table)} PARTITION ({RUN_COLUMN} = '{run}', {PLACE_COLUMN}) "
        "SELECT * FROM {rows}",
        rows=placed.sortWithinPartitions(PLACE_COLUMN, *sort),
    )
    written = spark.table(runs_table(table)).where(F.col(RUN_COLUMN) == run).count()
    runs = {name: count for name, count in state.runs.items() if name not in merged}
    after = replace(after, runs=runs | ({run: written} if written else {}))
    _show(spark, table, after)
    tidy(spark, table, after)
    return after


def _merged(runs: dict[str, int], fresh: int) -> list[str]:
    """The runs that a new one takes in, so that each run left is larger than all smaller together."""
    ordered = sorted(runs, key=runs.__getitem__)
    smaller, take = fresh, 0
    for place, name in enumerate(ordered):
        if runs[name] <= smaller:
            take = place + 1
        smaller += runs[name]
    return ordered[:take]


def tidy(spark: SparkSession, table: str, state: Folds | None = None) -> None:
    """Drop the partitions that the state does not show: folded batches and replaced runs."""
    state = state or folds_of(spark, table)
    if state is None:
        return
    live = _partitions(spark, table)
    drop_partitions(spark, table, [spec for spec in live if state.holds(spec[BATCH_COLUMN])])
    runs = runs_table(table)
    if spark.catalog.tableExists(runs):
        stored = _partitions(spark, runs)
        drop_partitions(spark, runs, [spec for spec in stored if spec[RUN_COLUMN] not in state.runs])


def drop_partitions(
    spark: SparkSession, table: str, specs: Sequence[dict[str, str | None]]
) -> None:
    """Drop partitions, many in one statement."""
    texts = []
    for spec in specs:
        parts = (f"{k} = {'NULL' if v is None else quoted_text(v)}" for k, v in spec.items())
        texts.append(f"PARTITION ({', '.join(parts)})")
    for start in range(0, len(texts), _AT_ONCE):
        together = ", ".join(texts[start : start + _AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {together}")
