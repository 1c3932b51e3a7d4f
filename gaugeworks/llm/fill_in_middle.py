"""Fill-in-middle forms of texts that lie in seekable compressed frames.

A text is stored as independent zstandard frames with the units and code points before each of them
(a unit is a line with its line end). A cut after so many units is found by the counts; only the frame
it falls into is decompressed. Outputs are streamed frame by frame, in the order of the form, into
texts or digests, so that no more than one frame of a text is open at a time.

Edge cases: NULL counts as empty text; an empty text has no frame and is ``plain``; so is a text that
contains a marker. A line may span any number of frames, so very long texts and lines are cut like short
ones. A NULL id hashes as an empty one. Equal rows give equal forms. Rows and columns are kept, a
column of the input named like a new one as ``<name>_in``; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import OWN, set_aside

# Code points of a frame.
FRAME_CHARS = 1 << 15

# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

# The order in which a form writes the parts.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_CUT, _DIGEST = f"{OWN}cut", f"{OWN}digest"

FRAME = "struct<units_before:bigint,chars_before:bigint,data:binary>"
STORED = f"struct<n_units:bigint,n_chars:bigint,marked:boolean,frames:array<{FRAME}>>"


def pack(text: str, size: int = FRAME_CHARS) -> dict:
    """The frames of a text and what is known of the whole."""
    compressor = zstandard.ZstdCompressor(level=1)
    frames, ends = [], 0
    for start in range(0, len(text), size):
        part = text[start : start + size]
        frames.append(
            {
                "units_before": ends,
                "chars_before": start,
                "data": compressor.compress(part.encode()),
            }
        )
        ends += part.count("\n")
    return {
        "n_units": ends + (not text.endswith("\n") and bool(text)),
        "n_chars": len(text),
        "marked": any(marker in text for marker in MARKERS),
        "frames": frames,
    }


class Frames:
    """A stored text, read without opening more frames than asked for."""

    def __init__(self, stored: dict):
        self.stored, self.frames = stored, stored["frames"]
        self.first = [frame["chars_before"] for frame in self.frames]
        self.open = zstandard.ZstdDecompressor().decompress

    def part(self, number: int) -> str:
        return self.open(self.frames[number]["data"]).decode()

    def place(self, units: int) -> int:
        """Code points before the end of the first ``units`` units."""
        if units <= 0:
            return 0
        if units >= self.stored["n_units"]:
            return self.stored["n_chars"]
        # The frame with the line end: the last one that has fewer line ends before it.
        number = bisect_right(self.frames, units - 1, key=lambda f: f["units_before"]) - 1
        text, found = self.part(number), -1
        for _ in range(units - self.frames[number]["units_before"]):
            found = text.index("\n", found + 1)
        return self.first[number] + found + 1

    def read(self, start: int, end: int) -> Iterator[str]:
        """The code points from ``start`` to ``end``, a frame at a time."""
        if start >= end:
            return
        for number in range(bisect_right(self.first, start) - 1, len(self.frames)):
            offset = self.first[number]
            if offset >= end:
                return
            yield self.part(number)[max(start - offset, 0) : end - offset]


def rendered(frames: Frames, form: str, cuts: tuple[int, int]) -> Iterator[str]:
    """The pieces of a form's output, in order."""
    size = frames.stored["n_chars"]
    if form not in ORDERS:
        yield from frames.read(0, size)
        return
    spans = {PREFIX: (0, cuts[0]), MIDDLE: cuts, SUFFIX: (cuts[1], size)}
    for marker in ORDERS[form]:
        yield marker
        yield from frames.read(*spans[marker])


def restored(pieces: Iterable[str], form: str) -> Iterator[str]:
    """The text, from an output and its form alone: the markers are looked for in the stream.

    Prefix and middle come in the order of the text; only the suffix is kept back, compressed.
    """
    if form not in ORDERS:
        yield from pieces
        return
    order = ORDERS[form]
    compressor, kept = zstandard.ZstdCompressor(level=1), []
    passed, rest = 0, ""

    def given(text: str) -> Iterator[str]:
        if order[passed - 1] == SUFFIX:
            kept.append(compressor.compress(text.encode()))
        elif text:
            yield text

    for piece in pieces:
        rest += piece
        while passed < len(order) and (at := rest.find(order[passed])) >= 0:
            yield from given(rest[:at])
            rest = rest[at + len(order[passed]) :]
            passed += 1
        # The start of a marker may end this piece.
        sure = len(rest) if passed == len(order) else max(len(rest) - 2, 0)
        yield from given(rest[:sure])
        rest = rest[sure:]
    yield from given(rest)
    for data in kept:
        yield zstandard.ZstdDecompressor().decompress(data).decode()


def _digest(pieces: Iterable[str]) -> str:
    total = hashlib.sha256()
    for piece in pieces:
        total.update(piece.encode())
    return total.hexdigest()


def _mapped(kind: str, change: Callable) -> Callable:
    """An Arrow function that gives one value of the type for each row, row by row."""

    def run(batches: Iterator) -> Iterator[pa.Array]:
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            rows = zip(*columns, strict=True)
            changed = [change(*(value.as_py() for value in row)) for row in rows]
            yield pa.array(changed, _ARROW[kind])

    return F.arrow_udf(run, kind, F.ArrowUDFType.SCALAR_ITER)


_ARROW = {
    STORED: pa.struct(
        [
            ("n_units", pa.int64()),
            ("n_chars", pa.int64()),
            ("marked", pa.bool_()),
            (
                "frames",
                pa.list_(
                    pa.struct(
                        [
                            ("units_before", pa.int64()),
                            ("chars_before", pa.int64()),
                            ("data", pa.binary()),
                        ]
                    )
                ),
            ),
        ]
    ),
    "struct<first:bigint,second:bigint>": pa.struct([("first", pa.int64()), ("second", pa.int64())]),
    "struct<output:string,restored:string>": pa.struct(
        [("output", pa.string()), ("restored", pa.string())]
    ),
    "string": pa.string(),
}


def store_frames(
    documents: DataFrame, text_column: str = "text", stored: str = "stored", size: int = FRAME_CHARS
) -> DataFrame:
    """The documents with their frames in place of the text."""
    documents = set_aside(documents, stored)
    packing = _mapped(STORED, lambda text: pack(text or "", size))
    return documents.withColumn(stored, packing(F.col(text_column))).drop(text_column)


def _draw(name: Column, place: int) -> Column:
    """The unsigned integer in one group of eight hexadecimal digits."""
    return F.conv(F.substring(name, 1 + 8 * place, 8), 16, 10).cast("long")


def with_plan(
    stored_texts: DataFrame,
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    id_column: str = "doc_id",
    stored: str = "stored",
) -> DataFrame:
    """Adds ``form`` and the cuts: ``from_unit``, ``to_unit`` in units, ``from_char``, ``to_char`` in code
    points (NULL if plain). All follow from seed and id; ``rate`` percent of the texts are changed, of
    them ``spm`` percent get the suffix first.
    """
    stored_texts = set_aside(
        stored_texts, "form", "from_unit", "to_unit", "from_char", "to_char"
    )
    key = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), key).cast("binary"), 256)
    text = F.col(stored)
    plain = (text["n_chars"] == 0) | text["marked"] | (_draw(name, 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_draw(name, 3) % 100 < spm, "spm").otherwise("psm")
    places = [_draw(name, k) % (text["n_units"] + 1) for k in (0, 1)]

    def cut(frames: dict, first: int | None, second: int | None) -> dict | None:
        if first is None:
            return None
        opened = Frames(frames)
        return {"first": opened.place(first), "second": opened.place(second)}

    find = _mapped("struct<first:bigint,second:bigint>", cut)
    return (
        stored_texts.withColumn("form", form)
        .withColumn("from_unit", F.when(F.col("form") != "plain", F.least(*places)))
        .withColumn("to_unit", F.when(F.col("form") != "plain", F.greatest(*places)))
        .withColumn(_CUT, find(text, F.col("from_unit"), F.col("to_unit")))
        .withColumn("from_char", F.col(_CUT)["first"])
        .withColumn("to_char", F.col(_CUT)["second"])
        .drop(_CUT)
    )


def with_output(planned: DataFrame, output: str = "output", stored: str = "stored") -> DataFrame:
    """Adds the whole output text of every planned row."""
    planned = set_aside(planned, output)
    render = _mapped(
        "string", lambda text, form, a, b: "".join(rendered(Frames(text), form, (a, b)))
    )
    return planned.withColumn(
        output, render(F.col(stored), F.col("form"), F.col("from_char"), F.col("to_char"))
    )


def with_restored(outputs: DataFrame, output: str = "output", text_column: str = "text") -> DataFrame:
    """Adds the text that an output was made from."""
    outputs = set_aside(outputs, text_column)
    rebuild = _mapped("string", lambda text, form: "".join(restored([text], form)))
    return outputs.withColumn(text_column, rebuild(F.col(output), F.col("form")))


def with_digests(planned: DataFrame, stored: str = "stored") -> DataFrame:
    """Adds ``output_sha256`` and ``restored_sha256``, both streamed: no output is built as a whole."""
    planned = set_aside(planned, "output_sha256", "restored_sha256")

    def digest(text: dict, form: str, first: int | None, second: int | None) -> dict:
        frames = Frames(text)
        return {
            "output": _digest(rendered(frames, form, (first, second))),
            "restored": _digest(restored(rendered(frames, form, (first, second)), form)),
        }

    both = _mapped("struct<output:string,restored:string>", digest)
    return (
        planned.withColumn(
            _DIGEST, both(F.col(stored), F.col("form"), F.col("from_char"), F.col("to_char"))
        )
        .withColumn("output_sha256", F.col(_DIGEST)["output"])
        .withColumn("restored_sha256", F.col(_DIGEST)["restored"])
        .drop(_DIGEST)
    )
