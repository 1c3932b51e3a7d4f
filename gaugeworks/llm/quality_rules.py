"""Quality rules: statistics of whole texts, and a decision list learnt from labelled ones.

The list is learnt by sequential covering: a rule starts empty and grows by the threshold condition
with the largest information gain on one half of the labelled rows, is cut back to the prefix that is
best on the other half, and the rows it covers are set aside before the next rule. Every step is one
Spark aggregate over binned statistics, so all labelled rows count and only a table of (statistic, bin,
label) counts reaches the driver. The result is an ordered CASE expression.

Statistics and rules are DataFrame functions throughout.

Edge cases: NULL and word-less texts have zero for every count and fail the base rules; labels of
unknown or NULL ids and NULL labels are ignored, of several labels of an id the lowest counts;
without labels of both kinds the list is empty and keeps whatever passes the base rules; repeated rows
are judged alike; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, written
from gaugeworks.sinks.quoting import quoted_name

BLANK = r"[\x09-\x0D\x20]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Further statistics that only the learnt rules use.
MORE_COUNTS = ("n_lines", "n_upper", "n_distinct_words")

# Cut points tried per statistic, conditions of a rule, rules of a list.
BINS = 32
MAX_CONDITIONS = 3
MAX_RULES = 8
# A rule must be right for this share of the held-back rows it covers, and cover so many of them.
PRECISION = 0.95
MIN_COVER = 5


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(windows: Column) -> Column:
    """Words inside the windows (hashes by place) that occur twice or more."""
    placed = F.sort_array(
        F.transform(windows, lambda value, k: F.struct(value.alias("v"), k.cast("long").alias("k")))
    )

    def covered(rows: Column) -> Column:
        twice = F.filter(
            rows,
            lambda row, k: F.get(rows, k - 1)["v"].eqNullSafe(row["v"])
            | F.get(rows, k + 1)["v"].eqNullSafe(row["v"]),
        )
        places = F.sort_array(F.transform(twice, lambda row: row["k"]))
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        return F.aggregate(
            places,
            zero,
            lambda done, k: F.struct(
                (done["n"] + k + 3 - F.greatest(k, done["end"])).alias("n"), (k + 3).alias("end")
            ),
            lambda done: done["n"],
        )

    unlike = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(unlike, F.lit(0).cast("long")).otherwise(_bound(placed, covered))


def with_statistics(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds the counts of ``COUNTS`` and ``MORE_COUNTS`` of every whole text (long)."""
    text, words = F.coalesce(F.col(text_column), F.lit("")), F.col(f"{OWN}words")
    lines, windows = F.col(f"{OWN}lines"), F.col(f"{OWN}windows")

    def left_of(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    starting = F.transform(
        words, lambda word, k: F.xxhash64(word, F.get(words, k + 1), F.get(words, k + 2))
    )
    window = F.slice(starting, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return (
        documents.withColumn(f"{OWN}words", F.array_remove(F.split(text, BLANK), ""))
        .withColumn(
            f"{OWN}lines", F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x09-\x0D\x20]"))
        )
        .withColumn(f"{OWN}windows", window)
        .withColumns(
            {
                name: value.cast("long")
                for name, value in {
                    "n_words": F.size(words),
                    "word_chars": F.length(F.array_join(words, "")),
                    "n_symbols": left_of(r"[^#*$%&|<>]+"),
                    "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
                    "n_repeat_words": _repeated(windows),
                    "n_lines": F.size(lines),
                    "n_upper": left_of(r"[^A-Z]+"),
                    "n_distinct_words": F.size(F.array_distinct(words)),
                }.items()
            }
        )
        .drop(f"{OWN}words", f"{OWN}lines", f"{OWN}windows")
    )


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def features() -> dict[str, Column]:
    """What conditions may be about, by name."""
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "n_words"),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "upper_case": _share("n_upper", "word_chars"),
        "distinct_words": _share("n_distinct_words", "n_words"),
        "words_per_line": _share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def expression(self) -> Column:
        value = features()[self.feature]
        return value > self.limit if self.above else value <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:g}"


Rule = tuple[Condition, ...]


def rule_number(rules: list[Rule]) -> Column:
    """The first rule that fits (from 1), NULL if none does."""
    found = F.lit(None).cast("int")
    for number in range(len(rules), 0, -1):
        fits = F.lit(True)
        for condition in rules[number - 1]:
            fits = fits & condition.expression()
        found = F.when(fits, F.lit(number)).otherwise(found)
    return found


def kept(rules: list[Rule]) -> Column:
    """The verdict: base rules passed and no rule of the list fits."""
    return ~base_failed() & rule_number(rules).isNull()


def keep_good(documents: DataFrame, rules: list[Rule], text_column: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    # The row mark keeps the optimizer from moving the filter, and with it copies of the
    # statistics, below the projections that compute them once.
    others = [name for name in documents.columns if name != text_column]
    packed = documents.select(
        F.struct(F.lit(0).alias(f"{OWN}none"), *map(quoted_name, others)).alias(f"{OWN}row"),
        F.col(text_column),
    )
    return (
        with_statistics(packed, text_column)
        .withColumn(f"{OWN}mark", F.monotonically_increasing_id())
        .filter(kept(rules) & (F.col(f"{OWN}mark") >= 0))
        .select(f"{OWN}row.*", text_column)
        .select(*map(quoted_name, documents.columns))
    )


def _gain(was_good: int, was_bad: int, good: int, bad: int) -> float:
    """Information gain of a condition for covering the ``bad`` rows."""
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(was_bad / (was_bad + was_good)))


def learn_rules(
    statistics: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    label_column: str = "quality",
) -> list[Rule]:
    """Rules that fit documents labelled 0, in order, from a table with the statistics."""
    named = (
        labels.filter(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .groupBy(F.col(id_column).alias(f"{OWN}id"))
        .agg(F.min(label_column).alias("label"))
    )
    values = features()
    rows = written(
        statistics.join(named, F.col(id_column) == F.col(f"{OWN}id"))
        .filter(~base_failed())
        .select(
            *(value.alias(name) for name, value in values.items()),
            (F.col("label") == 0).alias("bad"),
            (F.pmod(F.xxhash64(F.col(f"{OWN}id"), F.lit("fold")), F.lit(2)) == 0).alias("grow"),
        ),
        "quality-rows",
    )
    steps = [k / BINS for k in range(1, BINS)]
    cuts_row = rows.agg(
        *(
            F.percentile_approx(name, steps, 10_000).alias(f"{name}_{kind}")
            if kind == "all"
            else F.percentile_approx(F.when(F.col("bad"), F.col(name)), steps, 10_000).alias(
                f"{name}_{kind}"
            )
            for name in values
            for kind in ("all", "bad")
        )
    ).first()
    cuts = {
        name: sorted({*(cuts_row[f"{name}_all"] or ()), *(cuts_row[f"{name}_bad"] or ())})
        for name in values
    }
    binned = written(
        rows.groupBy(
            "bad",
            "grow",
            *(
                sum(((F.col(name) > cut).cast("int") for cut in cuts[name]), F.lit(0)).alias(name)
                for name in values
            ),
        ).count(),
        "quality-bins",
    )

    def counts(condition: Column) -> dict:
        """Rows by statistic, bin, label and half among those that fit."""
        pairs = F.explode(
            F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("bin")) for n in values))
        )
        found: dict = {}
        for row in (
            binned.filter(condition)
            .select("bad", "grow", "count", pairs.alias("p"))
            .groupBy("p.name", "p.bin", "bad", "grow")
            .agg(F.sum("count").alias("n"))
            .collect()  # statistics x bins x 4 rows at most
        ):
            found[row["name"], row["bin"], row["bad"], row["grow"]] = row["n"]
        return found

    def total(found: dict, bad: bool, grow: bool) -> int:
        name = next(iter(values))
        return sum(n for (f, _, b, g), n in found.items() if (f, b, g) == (name, bad, grow))

    rules: list[Rule] = []
    uncovered = F.lit(True)
    while len(rules) < MAX_RULES:
        chosen: list[tuple[str, bool, int]] = []
        fits, scores = uncovered, []
        while len(chosen) <= MAX_CONDITIONS:
            found = counts(fits)
            good, bad = total(found, False, True), total(found, True, True)
            held_good, held_bad = total(found, False, False), total(found, True, False)
            scores.append((held_bad, held_good))
            if not bad or not good or len(chosen) == MAX_CONDITIONS:
                break
            best, best_gain = None, 0.0
            for name in values:
                low_good = low_bad = 0
                for k in range(len(cuts[name])):
                    low_good += found.get((name, k, False, True), 0)
                    low_bad += found.get((name, k, True, True), 0)
                    for above, part in (
                        (False, (low_good, low_bad)),
                        (True, (good - low_good, bad - low_bad)),
                    ):
                        gain = _gain(good, bad, *part)
                        if gain > best_gain + 1e-9:
                            best, best_gain = (name, above, k), gain
            if best is None:
                break
            chosen.append(best)
            name, above, k = best
            fits = fits & (F.col(name) > k if above else F.col(name) <= k)
        # Cut back to the prefix that does best on the held-back half.
        worth = [(b - g) / (b + g) if b + g else -1.0 for b, g in scores]
        size = max(range(1, len(chosen) + 1), key=lambda n: (worth[n], -n), default=0)
        held_bad, held_good = scores[size]
        if not size or held_bad < MIN_COVER or held_bad < PRECISION * (held_bad + held_good):
            break
        # The limit lies halfway to the next value seen, so that it keeps a distance to both sides.
        nexts = rows.agg(
            *(
                F.min(F.when(F.col(n) > cuts[n][k], F.col(n))).alias(str(place))
                for place, (n, _, k) in enumerate(chosen[:size])
            )
        ).first()
        rules.append(
            tuple(
                Condition(n, above, (cuts[n][k] + (cuts[n][k] if after is None else after)) / 2)
                for (n, above, k), after in zip(chosen[:size], nexts, strict=True)
            )
        )
        covered = F.lit(True)
        for name, above, k in chosen[:size]:
            covered = covered & (F.col(name) > k if above else F.col(name) <= k)
        uncovered = uncovered & ~covered
    return rules
