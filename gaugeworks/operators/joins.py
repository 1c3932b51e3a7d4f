"""Joins of a large, possibly skewed side with a reference table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.session import scratch_dir
from gaugeworks.settings import JOIN_TASK_ROWS, MAX_BROADCAST_BYTES

_FIELD_OVERHEAD = 16
# Hot keys up to which their table is broadcast.
FEW_KEYS = 100_000
_PLAIN_TYPES = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df``, from one distributed aggregate over it."""
    variable = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            variable.append(F.octet_length(f.name))
        elif not isinstance(f.dataType, _PLAIN_TYPES):
            variable.append(F.octet_length(F.to_json(F.struct(f.name))))
    per_row = F.lit(_FIELD_OVERHEAD * (len(df.columns) + 1))
    for length in variable:
        per_row = per_row + F.coalesce(length, F.lit(0))
    return df.agg(F.sum(per_row.cast("long"))).first()[0] or 0


def salted_join(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str,
    task_rows: int = JOIN_TASK_ROWS,
) -> DataFrame:
    """Shuffle join in which a key of more than ``task_rows`` rows is spread over several tasks.

    An aggregate finds the hot keys, once; there are at most rows / ``task_rows`` of them, and they are
    broadcast only if they are few. Only their
    rows take a salt, from a hash of the row and its place in the input (which a scan reproduces),
    so exact copies are spread as well; only their rows of ``small`` are repeated, once per salt.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot salt a {how} join")
    salt, salts = "_salt", "_salts"
    spark, path = large.sparkSession, scratch_dir(large.sparkSession, "hot-keys")
    counted = (
        large.groupBy(*keys)
        .agg(F.count("*").alias(salts))
        .where(F.col(salts) > task_rows)
        .select(
            *[F.col(key).alias(f"_hot_{key}") for key in keys],
            F.ceil(F.col(salts) / task_rows).cast("int").alias(salts),
        )
    )
    counted.write.parquet(path)
    hot = spark.read.schema(counted.schema).parquet(path)
    if hot.count() <= FEW_KEYS:
        hot = F.broadcast(hot)

    def marked(side: DataFrame) -> DataFrame:
        same = F.lit(True)
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_hot_{key}"))
        found = side.join(hot, same, "left")
        return found.withColumn(salts, F.coalesce(salts, F.lit(1))).drop(
            *[f"_hot_{key}" for key in keys]
        )

    place = F.xxhash64(*large.columns).bitwiseXOR(F.monotonically_increasing_id())
    spread = marked(large.withColumn("_row", place)).withColumn(
        salt, F.pmod(F.col("_row"), F.col(salts)).cast("int")
    )
    repeated = marked(small).withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.col(salts) - 1))
    )
    joined = spread.drop(salts, "_row").join(repeated.drop(salts).hint("merge"), [*keys, salt], how)
    return joined.drop(salt)


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def join_reference(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    broadcast: bool | None = None,
) -> DataFrame:
    """Join ``large`` with a reference table without letting a hot key fill one task.

    The reference side is measured, unless ``broadcast`` carries an earlier answer. Within
    ``max_broadcast_bytes`` it is broadcast and ``large`` is not shuffled. Beyond, it is a
    shuffle join: adaptive execution splits the skewed partitions, and where that is off the
    keys are salted. The shuffle is asked for by a hint, as Spark's own estimate of the size
    may be lower than what was measured.
    """
    keys = list(keys)
    if broadcast is None:
        broadcast = fits_broadcast(small, max_broadcast_bytes)
    if broadcast:
        return large.join(F.broadcast(small), keys, how)
    conf = large.sparkSession.conf
    adaptive = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    if all(conf.get(name, "false") == "true" for name in adaptive):
        return large.join(small.hint("merge"), keys, how)
    return salted_join(large, small, keys, how)
