"""What several corpus operators share: row keys, written intermediates, hashing, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import scratch_dir

# Names of an operator's own working columns start with this, so that no user column clashes.
OWN = "__gw_"

# Bytes of distinct words a task remembers before it starts afresh, with what Python needs for an
# entry beside its text; bounds the memory, not the result.
WORD_BYTES = 32 << 20
ENTRY_BYTES = 150

# A joined side of at most so many narrow rows (some 24 bytes each) is broadcast.
BROADCAST_ROWS = 1_000_000


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame stored in the shared scratch folder and read back.

    It cuts the lineage, so a lost executor costs one task and not the whole job, and gives
    adaptive execution exact sizes.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """A hash that, together with the document id, names a row; NULL has one of its own."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))


def small(frame: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a narrow frame whose counted rows are within the bound."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def broadcast_value(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)


def release() -> None:
    """Hand memory that a finished task no longer needs back to the system, as workers live on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some systems have it
    if trim:
        trim(0)


def kept_in(shared: dict, name: str, build: Callable):
    """A value built once per Python worker and kept beside the broadcast it is made from."""
    if name not in shared:
        shared[name] = build()
    return shared[name]


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        if self.held > WORD_BYTES:
            self.clear()
            self.held = 0
        self.held += ENTRY_BYTES + len(word)
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes, in order; empty if there are fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, size, np.uint64)
    for place in range(size):
        total = total * _ODD + words[place : place + count]
    return mixed(total)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component) per node.

    The component is its smallest node. Each round hands the smallest label of the neighbours
    on, lets every label follow its own label, and is written, so the plan does not grow. The
    minimum combines before it shuffles, so a node with very many edges is no burden.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{label}-e"
    )
    labels = written(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("component")),
        f"{label}-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        root = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        following = written(
            lower.join(root, "component").select(
                "node", "was", F.least("component", "root").alias("component")
            ),
            f"{label}-{step}",
        )
        changed = following.filter("component <> was").limit(1).count()
        labels = following.select("node", "component")
        if not changed:
            return labels


def set_aside(frame: DataFrame, *names: str) -> DataFrame:
    """The frame with columns that are named like one to be added renamed to ``<name>_in``.

    Names are compared as Spark does, without case; underscores are added until the name is free.
    """
    added = {name.lower() for name in names}
    taken = added | {name.lower() for name in frame.columns}
    columns = []
    for name in frame.columns:
        if name.lower() in added:
            name += "_in"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        columns.append(name)
    return frame.toDF(*columns) if columns != frame.columns else frame
