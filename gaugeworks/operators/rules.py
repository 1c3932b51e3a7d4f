"""Quality rules: flag, reason and the split into valid and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.columns import UNREADABLE
from gaugeworks.settings import QUARANTINE_RULES, VALID_REASON, Rule

FLAG = "is_quarantined"
REASON = "quarantine_reason"

# Opt-in rule for rows read with ``rename_cast(lenient=True)``.
UNREADABLE_RULE = Rule(f"size({UNREADABLE}) > 0", "ERROR: Unreadable value")


class Split(NamedTuple):
    valid: DataFrame
    quarantined: DataFrame
    unknown: DataFrame


def rule_flag(rules: Sequence[Rule] = QUARANTINE_RULES) -> Column:
    """True when a rule hits, NULL when none does but one could not be decided."""
    return reduce(or_, [F.expr(rule.predicate) for rule in rules])


def rule_reason(rules: Sequence[Rule] = QUARANTINE_RULES) -> Column:
    """Reason of the first rule that hits."""
    hits = [F.when(F.expr(rule.predicate), F.lit(rule.reason)) for rule in rules]
    return F.coalesce(*hits, F.lit(VALID_REASON))


def evaluate_rules(df: DataFrame, rules: Sequence[Rule] = QUARANTINE_RULES) -> DataFrame:
    return df.withColumns({FLAG: rule_flag(rules), REASON: rule_reason(rules)})


def split_evaluated(evaluated: DataFrame, null_policy: str = "drop") -> Split:
    """Valid, quarantined and undecided rows of a frame that carries flag and reason.

    A NULL flag satisfies neither branch. ``null_policy`` says where such rows go: "drop"
    leaves them out of both, "valid" and "quarantine" add them to that branch. ``unknown``
    always holds them, for counting.
    """
    flag = F.col(FLAG)
    valid, quarantined = ~flag, flag
    if null_policy == "valid":
        valid = F.coalesce(valid, F.lit(True))
    elif null_policy == "quarantine":
        quarantined = F.coalesce(quarantined, F.lit(True))
    elif null_policy != "drop":
        raise ValueError(f"null_policy must be drop, valid or quarantine, not {null_policy!r}")
    return Split(
        evaluated.where(valid).drop(FLAG, REASON, UNREADABLE),
        evaluated.where(quarantined),
        evaluated.where(flag.isNull()),
    )


def split_by_rules(
    df: DataFrame,
    rules: Sequence[Rule] = QUARANTINE_RULES,
    null_policy: str = "drop",
) -> Split:
    return split_evaluated(evaluate_rules(df, rules), null_policy)


def route_measures() -> list[Column]:
    """How many rows are valid, quarantined and undecided, as aggregates."""
    flag = F.col(FLAG)
    return [
        F.count_if(~flag).alias("valid"),
        F.count_if(flag).alias("quarantined"),
        F.count_if(flag.isNull()).alias("unknown"),
    ]


def route_counts(evaluated: DataFrame) -> DataFrame:
    """One row: how many rows are valid, quarantined and undecided."""
    return evaluated.agg(*route_measures())
