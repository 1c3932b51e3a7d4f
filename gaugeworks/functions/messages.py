"""JSON text to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.settings import CORRUPT_COLUMN, RESCUED_COLUMN


def encode_keyed(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """One (key, value) message per row: the key as integer text, the row as a JSON object.

    NULL fields are written as JSON null, so that every message has the same keys.
    """
    body = F.struct(*(columns or df.columns))
    return df.select(
        F.col(key).cast("int").cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def decode_messages(
    df: DataFrame,
    schema: T.StructType | str,
    value: str = "value",
    rescued: str | None = None,
) -> DataFrame:
    """Replace the JSON text (or bytes) in ``value`` by the columns of ``schema``.

    With ``rescued``, a column of that name takes what the schema cannot hold of a message:
    unknown keys, values of another type, and text that is no JSON object, whole. No row is lost;
    a NULL or blank message has NULL everywhere.
    """
    others = [name for name in df.columns if name != value]
    text = F.col(value).cast("string")
    if rescued is None:
        read = df.select(*others, F.from_json(text, schema).alias("_body"))
        return read.select(*others, "_body.*")
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = df.select(*others, text.alias("_text")).withColumn("_body", _with_corrupt("_text", kind))
    return read.select(
        *others,
        *[F.col("_body")[f.name].alias(f.name) for f in kind.fields],
        F.when(F.length(F.trim("_text")) > 0, rescue_unread(F.col("_text"), F.col("_body"), kind))
        .alias(rescued),
    )


def _with_corrupt(text: str, schema: T.StructType) -> Column:
    """The text read by ``schema`` plus the corrupt-record column."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return F.from_json(F.col(text), full, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})


def rescue_unread(text: Column, parsed: Column, schema: T.StructType) -> Column:
    """JSON object of the fields of ``text`` that ``parsed`` does not hold, else NULL.

    Those are the keys outside ``schema`` and the values that do not fit their type. Text that
    is no JSON object is kept whole. ``parsed`` must carry the corrupt-record column. The keys are
    listed by a second pass over the text only where a column is missing or ``_has_more_keys``; the
    third, generic parse runs only for rows where something is left over.
    """
    names = [f.name for f in schema.fields]
    known = F.array(*map(F.lit, names)).cast("array<string>")
    read = F.array_compact(
        F.array(*[F.when(parsed[name].isNotNull(), F.lit(name)) for name in names])
    ).cast("array<string>")
    unknown = F.coalesce(F.size(F.array_except(F.json_object_keys(text), known)) > 0, F.lit(True))
    suspect = _has_more_keys(text, len(names))
    for name in names:
        suspect = suspect | parsed[name].isNull()
    extra = F.when(suspect, unknown).otherwise(F.lit(False))
    left_over = F.map_filter(
        F.from_json(text, "map<string,string>"),
        lambda key, value: ~F.array_contains(read, key)
        & (value.isNotNull() | ~F.array_contains(known, key)),
    )
    whole = F.to_json(F.create_map(F.lit(CORRUPT_COLUMN), text))
    kept = F.coalesce(F.nullif(F.to_json(left_over), F.lit("{}")), whole)
    return F.when(extra | parsed[CORRUPT_COLUMN].isNotNull(), kept)


def _has_more_keys(text: Column, known: int) -> Column:
    """Whether a JSON text may have more keys, at any depth, than the ``known`` ones it has.

    Each key ends in a quote, blanks and a colon. Without a single quote or a blank before any colon
    the keys are at most the places of a double quote and a colon; such a pair inside a value
    only means a closer look.
    """
    pairs = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('":'), F.lit("")))
    more = pairs != F.lit(2 * known)
    for before in ("'", " ", "\t", "\n", "\r"):
        more = more | F.contains(text, F.lit(f"{before}:"))
    return more


def parse_json_lines(
    lines: DataFrame,
    schema: T.StructType,
    value: str = "value",
    rescued: str = RESCUED_COLUMN,
) -> DataFrame:
    """Columns of ``schema`` plus the rescue column, from one JSON object per row of text.

    Blank rows are skipped, other columns of ``lines`` are passed on.
    """
    others = [name for name in lines.columns if name != value]
    read = lines.where(F.length(F.trim(F.col(value))) > 0).withColumn(
        "_body", _with_corrupt(value, schema)
    )
    return read.select(
        *[F.col("_body")[f.name].alias(f.name) for f in schema.fields],
        rescue_unread(F.col(value), F.col("_body"), schema).alias(rescued),
        *others,
    )


def explode_readings(
    df: DataFrame,
    value: str,
    element: str = "struct<sensor:string,reading:double>",
    rescued: str = RESCUED_COLUMN,
) -> DataFrame:
    """One row per element of the JSON array of objects in ``value``.

    An array that is empty, NULL or unreadable gives one row of NULLs; unreadable text, and
    elements with a part that the type cannot hold, are kept whole in the rescue column.
    """
    others = [name for name in df.columns if name != value]
    fields = [f.name for f in T.StructType.fromDDL(element.removeprefix("struct<")[:-1]).fields]
    known = F.array(*map(F.lit, fields))
    read = df.select(*others, F.col(value).alias("_text")).withColumn(
        "_items", F.from_json("_text", f"array<{element}>")
    )

    def gap(item: Column) -> Column:
        found = item.isNull()
        for name in fields:
            found = found | item[name].isNull()
        return found

    # Nothing is lost of an array whose items have all their fields and whose text has no more keys
    # than that (a quote and a colon inside a value count as one, which only means a closer look).
    # The elements of all other arrays are taken as text and looked at one by one.
    keys = F.regexp_count("_text", F.lit(r'"\s*:'))
    clean = ~F.exists("_items", gap) & (keys == F.size("_items") * len(fields))
    raw = F.when(
        F.col("_items").isNotNull() & ~F.coalesce(clean, F.lit(False)),
        F.from_json("_text", "array<string>"),
    )
    one = (
        read.withColumn("_raw", raw)
        .select(
            *others,
            F.when(F.col("_items").isNull(), F.col("_text")).alias("_whole"),
            "_raw",
            F.posexplode_outer("_items").alias("_place", "_item"),
        )
        .withColumn("_piece", F.get("_raw", F.col("_place")))
    )
    piece = F.col("_piece")
    keys = F.json_object_keys(piece)
    broken = keys.isNull() | (F.size(F.array_except(keys, known)) > 0)
    for name in fields:
        there = F.get_json_object(piece, f"$.{name}").isNotNull()
        broken = broken | (F.col("_item")[name].isNull() & there)
    kept = F.when(piece.isNotNull() & broken, piece)
    return one.select(*others, "_item.*", F.coalesce("_whole", kept).alias(rescued))
