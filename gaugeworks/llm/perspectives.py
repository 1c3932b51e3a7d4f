"""Chat formatting by perspective rotation.

A dialogue is rendered once for every participant: that speaker's turns as the assistant's, everyone
else's as those of named users, instructions as they are. The mask marks what the speaker said (with
the end mark), which is what a model is trained on.

A long dialogue is rendered in parts of at most ``turns_per_part`` turns that follow each other,
so no task holds a whole dialogue, however long. There are turns x participants rendered turns, which
is what the operation is about; nothing else is paired.

DataFrame functions throughout.

Edge cases: NULL text is empty text; turns of a NULL role are a user's without a name, who gets no
perspective; rows without a dialogue id are one dialogue of id NULL; turns of equal number follow by
role and text, repeated rows one after the other, NULL numbers come first; very long texts are rendered
whole; markup in texts and names is made harmless; a dialogue of instructions only has no perspective; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, written

TURNS_PER_PART = 64
INSTRUCTIONS = ("system",)
END = "<|end|>"


def _plain(text: Column) -> Column:
    """Text whose own markup cannot be taken for ours."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate_perspectives(
    turns: DataFrame,
    dialogue: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    instructions: tuple[str, ...] = INSTRUCTIONS,
    turns_per_part: int = TURNS_PER_PART,
) -> DataFrame:
    """Rows (dialogue, speaker, part, n_turns, start, rendered, mask).

    The parts of a dialogue and speaker, joined in order, are the whole rendering. ``start`` is where the
    part begins in it, ``mask`` has the spans (start, end) of the speaker's turns in it; both in
    characters. Parts are cut by the place of a turn in the dialogue, whatever its number: turns are
    counted by ranges of numbers first, then ranked inside a range.
    """
    base = turns.select(
        F.to_json(F.struct(F.col(dialogue).alias("d"))).alias("key"),
        F.col(dialogue).alias("d"),
        F.col(order).cast("long").alias("t"),
        F.col(role).cast("string").alias("r"),
        F.col(text).cast("string").alias("x"),
    ).withColumn("range", F.floor(F.col("t") / turns_per_part))
    speakers = written(
        base.filter(F.col("r").isNotNull() & ~F.col("r").isin(*instructions))
        .select(F.col("key").alias(f"{OWN}key"), F.col("r").alias("speaker"))
        .distinct(),
        "perspective-speakers",
    )
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = written(
        base.groupBy("key", "range")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("key").alias(f"{OWN}key"),
            F.col("range").alias(f"{OWN}range"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        ),
        "perspective-ranges",
    )
    row = F.row_number().over(Window.partitionBy("key", "range").orderBy("t", "r", "x")) - 1
    numbered = written(
        base.withColumn("row", row)
        .join(
            ranges,
            (F.col("key") == F.col(f"{OWN}key")) & F.col("range").eqNullSafe(F.col(f"{OWN}range")),
        )
        .withColumn("place", F.col("before") + F.col("row"))
        .withColumn("part", F.floor(F.col("place") / turns_per_part).cast("int"))
        .select("key", "d", "r", "x", "place", "part"),
        "perspective-turns",
    )
    own = F.coalesce(F.col("r") == F.col("speaker"), F.lit(False))
    head = (
        F.when(own, F.lit("<|assistant|>\n"))
        .when(F.col("r").isin(*instructions), F.concat(F.lit("<|"), _plain(F.col("r")), F.lit("|>\n")))
        .when(F.col("r").isNull(), F.lit("<|user|>\n"))
        .otherwise(F.concat(F.lit("<|user "), _plain(F.col("r")), F.lit("|>\n")))
    )
    body = F.concat(_plain(F.col("x")), F.lit(END))
    seen = numbered.join(speakers, F.col("key") == F.col(f"{OWN}key"))
    parts = ["key", "speaker", "part"]
    # The characters before each part: sizes alone are summed along a dialogue, no texts.
    earlier = Window.partitionBy("key", "speaker").orderBy("part")
    starts = written(
        seen.groupBy(*parts)
        .agg(F.sum((F.length(head) + F.length(body) + 1).cast("long")).alias("size"))
        .withColumn("start", F.sum("size").over(earlier) - F.col("size"))
        .drop("size"),
        "perspective-starts",
    )
    pieces = seen.groupBy(*parts).agg(
        F.first("d").alias("d"),
        F.array_sort(
            F.collect_list(F.struct("place", head.alias("head"), body.alias("body"), own.alias("own")))
        ).alias("pieces"),
    )
    line = F.lit("\n")
    begun = F.struct(
        F.col("start").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    )

    def grown(done: Column, piece: Column) -> Column:
        begin = done["at"] + F.length(piece["head"])
        end = begin + F.length(piece["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"),
            F.when(piece["own"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"),
        )

    return pieces.join(starts, parts).select(
        F.col("d").alias(dialogue),
        "speaker",
        "part",
        F.size("pieces").alias("n_turns"),
        "start",
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["body"], line)), ""
        ).alias("rendered"),
        F.aggregate("pieces", begun, grown, lambda done: done["spans"]).alias("mask"),
    )
