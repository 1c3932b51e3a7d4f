"""N-gram Jaccard join: links of texts whose word-shingle sets are similar, and their groups.

``jaccard_join`` is the join: every link of two different sets with its overlap, and whose set is
whose. ``jaccard_components`` is a short cut to the groups alone: it leaves out what cannot change
a group, so it has no full list of links.

Vertical partitioning. All shingles have one global order: those that are not frequent first (by
hash), the frequent ones after them (by frequency). The order is cut at pivots of equal weight into
fragments. Only a text's first shingles in the order can start a link, so they alone are compared
across texts to find pairs; each fragment then counts its part of the overlap of a pair by itself, and
the parts of a pair are summed and held against the threshold.

Texts with the same set are one class from the start and are never paired. The join tries all pairs
of a list of texts with a first shingle in common. For the groups alone a list is first tried against
one of its texts; what that joins needs no further comparing, and the rest is tried against all texts
of its lists in other groups. Lists with the same texts count once, and a pair that has several lists
in common is made in the first of them only. Pairs whose bitmaps (exact lower bounds of the difference) or sizes rule
a link out never leave the join; every filter is a bound, none is a guess.

Edge cases: NULL or word-less text has no shingle and is linked with nothing; fewer words than a
shingle count as one shingle of all of them; repeated rows and repeated ids are rows of their own
(they get the component of their text); a NULL id never names a component; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import (
    WordHashes,
    broadcast_value,
    components,
    gram_hashes,
    release,
    small,
    text_key,
    written,
)

# Shingles of the order's tail, ranked by frequency; any number gives the same links.
FREQUENT = 1 << 20
# Sets of one batch that have a shingle, from which on it is counted as frequent.
OFTEN = 3
# Words of the bitmap that bounds how much two sets differ.
BITMAP_LONGS = 8
# Finer bitmaps by the size of a set, used where both sets of a pair have them: name, words, sizes.
# The ranges overlap by more than two linked sets differ in size.
WIDE_BITMAPS = (("fine", 16, 0, 800), ("wide", 32, 600, 3000), ("wider", 128, 2400, 1 << 62))
# Set ids a task remembers to pass over copies; copies it forgets do no harm.
SEEN = 1 << 18
# Vertical fragments a set is cut into when the overlap of a pair is counted (a power of two).
FRAGMENTS = 8


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = hashes.of(text.lower().split())
    return np.unique(gram_hashes(words, min(size, len(words)) or 1))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _set_id(values: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def _sets(batch: pa.RecordBatch, size: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    for text in batch.column("text"):
        yield shingle_set((text.as_py() or "").encode(), size, hashes)


def _summaries(size: int):
    """Per text its set's size and id; per batch the shingles that are frequent in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = list(_sets(batch, size, hashes))
            count = len(sets)
            ids = [_set_id(s) for s in sets]
            distinct = dict(zip(ids, sets, strict=True)).values()
            all_values = np.concatenate([*distinct, np.empty(0, np.uint64)])
            values, often = np.unique(all_values, return_counts=True)
            chosen = often >= OFTEN
            values, often = values[chosen], often[chosen]
            blank = pa.nulls(len(values), pa.int64())
            gap = pa.nulls(count, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), blank]),
                    pa.concat_arrays([batch.column("tkey"), blank]),
                    pa.concat_arrays([pa.array([len(s) for s in sets], pa.int64()), blank]),
                    pa.concat_arrays([pa.array(ids, pa.int64()), blank]),
                    pa.concat_arrays([gap, pa.array(_signed(values))]),
                    pa.concat_arrays([gap, pa.array(often.astype(np.int64))]),
                ],
                names=["doc_id", "tkey", "n", "sid", "shingle", "often"],
            )
        hashes.clear()
        release()

    return run


def bitmap(values: np.ndarray, longs: int = BITMAP_LONGS) -> np.ndarray:
    """Parity bits of a set: each differing shingle of two sets flips at most one bit."""
    bits = 64 * longs
    odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(size: int, percent: int, frequent):
    """The first shingles of every set in the global order, with the set's bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        known, rank, _ = frequent.value
        for batch in batches:
            sids, sizes, maps, firsts = [], [], [], []
            wide: dict[str, list] = {name: [] for name, *_ in WIDE_BITMAPS}
            for values in _sets(batch, size, hashes):
                sid = _set_id(values)
                if not len(values) or sid in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sid)
                length = len(values) - (len(values) * percent + 99) // 100 + 1
                if len(known):
                    values = values[np.argsort(_ranks(values, known, rank), kind="stable")]
                sids.append(sid)
                sizes.append(len(values))
                maps.append(bitmap(values))
                for name, longs, least, most in WIDE_BITMAPS:
                    fits = least < len(values) <= most
                    wide[name].append(bitmap(values, longs) if fits else None)
                firsts.append(_signed(values[:length]))
            flat = np.concatenate([*firsts, np.empty(0, np.int64)])
            ends = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            bits = np.array(maps, np.int64).reshape(-1, BITMAP_LONGS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(bits[:, k]) for k in range(BITMAP_LONGS)),
                    *(pa.array(rows, pa.list_(pa.int64())) for rows in wide.values()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["sid", "n", *(f"b{k}" for k in range(BITMAP_LONGS)), *wide, "prefix"],
            )
        hashes.clear()
        release()

    return run


def pivots(plain: int, often: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the global order is cut into fragments of equal weight: hashes, then frequencies.

    ``plain`` occurrences are of shingles that are not ranked, spread evenly over the hashes;
    ``often`` are the occurrences of the ranked ones.
    """
    often = np.sort(often)
    total, summed = plain + int(often.sum()), np.cumsum(often)
    hashes, ranks = [], []
    for weight in (total * k // fragments for k in range(1, fragments)):
        if weight < plain:
            hashes.append((weight << 64) // plain)
        elif len(often):
            ranks.append(often[min(np.searchsorted(summed, weight - plain), len(often) - 1)])
    return np.array(hashes, np.uint64), np.unique(np.array(ranks, np.int64))


def _ranks(values: np.ndarray, known: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The frequency of each shingle as far as it is ranked, else 0."""
    if not len(known):
        return np.zeros(len(values), np.int64)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[place] == values, rank[place], 0)


def fragments_of(values: np.ndarray, ranks: np.ndarray, cuts: tuple) -> np.ndarray:
    """The fragment of the global order that each shingle is in."""
    hashes, often = cuts
    plain = np.searchsorted(hashes, values, "right")
    ranked = len(hashes) + np.searchsorted(often, ranks, "right")
    return np.where(ranks == 0, plain, ranked)


def _fragments(size: int, order):
    """Every set cut at the pivots of the global order: rows (sid, fragment, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        known, rank, cuts = order.value
        for batch in batches:
            sids, places, parts = [], [], []
            for sid, values in zip(
                batch.column("sid").to_pylist(), _sets(batch, size, hashes), strict=True
            ):
                if sid in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sid)
                fragment = fragments_of(values, _ranks(values, known, rank), cuts)
                for place in np.unique(fragment).tolist():
                    sids.append(sid)
                    places.append(place)
                    parts.append(_signed(values[fragment == place]))
            flat = np.concatenate([*parts, np.empty(0, np.int64)])
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sids, pa.int64()),
                    pa.array(places, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["sid", "fragment", "shingles"],
            )
        hashes.clear()
        release()

    return run


def _flips(left: str, right: str, name: str):
    """How many bits of a finer bitmap differ; NULL where a set of the pair lacks it."""
    flips = F.zip_with(
        f"{left}.{name}", f"{right}.{name}", lambda a, b: F.bit_count(a.bitwiseXOR(b))
    )
    return F.aggregate(flips, F.lit(0), lambda done, n: done + n)


def _may_link_fine(left: str, right: str, percent: int):
    """The same bound by the finer bitmaps."""
    total = F.col(f"{left}.n") + F.col(f"{right}.n")
    fits = F.lit(True)
    for name, *_ in WIDE_BITMAPS:
        few = _flips(left, right, name) * (100 + percent) <= total * (100 - percent)
        fits = fits & F.coalesce(few, F.lit(True))
    return fits


def _may_link(left: str, right: str, percent: int):
    """Exact bounds on a pair: sizes not too far apart, bitmaps not too different."""
    n_left, n_right = F.col(f"{left}.n"), F.col(f"{right}.n")
    differ = sum(
        F.bit_count(F.col(f"{left}.b{k}").bitwiseXOR(F.col(f"{right}.b{k}")))
        for k in range(BITMAP_LONGS)
    )
    return (F.least(n_left, n_right) * 100 >= F.greatest(n_left, n_right) * percent) & (
        differ * (100 + percent) <= (n_left + n_right) * (100 - percent)
    )


def _linked(
    pairs: DataFrame, texts: DataFrame, owners: DataFrame, order, size: int, percent: int
) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose overlap, summed over the fragments, is large enough."""
    wanted = written(
        pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), "jaccard-wanted"
    )
    rows = wanted.count()
    chosen = owners.join(small(wanted, rows), "sid").select("sid", "doc_id", "tkey")
    found = (
        texts.alias("t")
        .join(
            small(chosen, rows).alias("o"),
            F.col("t.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("t.tkey") == F.col("o.tkey")),
        )
        .select("o.sid", "t.text")
    )
    segments = written(
        found.mapInArrow(_fragments(size, order), "sid long, fragment int, shingles array<long>"),
        "jaccard-fragments",
    )
    left = segments.select(
        F.col("sid").alias("a"), "fragment", F.col("shingles").alias("left_part")
    )
    right = segments.select(
        F.col("sid").alias("b"), "fragment", F.col("shingles").alias("right_part")
    )
    partial = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select(
            *("a", "b", "n_a", "n_b", "fragment"),
            F.size(F.array_intersect("left_part", "right_part")).alias("part"),
        )
    )
    # Repeated rows may give a fragment twice; the set has each of them once.
    return (
        partial.groupBy("a", "b", "n_a", "n_b")
        .agg(F.collect_set(F.struct("fragment", "part")).alias("parts"))
        .withColumn("common", F.aggregate("parts", F.lit(0), lambda done, p: done + p["part"]))
        .drop("parts")
        .filter(F.col("common") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent)
    )


def _first_in_common(left: str, right: str):
    """Whether the list that a pair meets in is the first one that both have."""
    both = F.array_intersect(f"{left}.shingles", f"{right}.shingles")
    return F.array_min(both) == F.col(f"{left}.shingle")


class _Index(NamedTuple):
    """The inverted index of first shingles, and what is known of the sets in it."""

    texts: DataFrame
    members: DataFrame
    lists: DataFrame
    narrow: DataFrame
    profile: DataFrame
    owners: DataFrame
    order: object
    size: int
    percent: int

    def bounded(self, candidates: DataFrame, name: str) -> DataFrame:
        """Candidate pairs (a, b) that the bounds let pass, with the least their sets differ."""
        pairs, wide = candidates, [name for name, *_ in WIDE_BITMAPS]
        for bound, own in ((_may_link, self.narrow), (_may_link_fine, self.profile)):
            fine = own is self.profile
            flips = F.coalesce(*(_flips("x", "y", w) for w in wide)) if fine else F.lit(0)
            pairs = written(
                pairs.select("a", "b")
                .join(own.alias("x"), F.col("a") == F.col("x.sid"))
                .join(own.alias("y"), (F.col("b") == F.col("y.sid")) & bound("x", "y", self.percent))
                .select(
                    *("a", "b", F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")),
                    flips.alias("flips"),
                ),
                f"jaccard-pairs-{name}",
            )
        return pairs

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose overlap is large enough, with the overlap (common)."""
        pairs = pairs.select("a", "b", "n_a", "n_b")
        found = _linked(pairs, self.texts, self.owners, self.order, self.size, self.percent)
        return written(found, f"jaccard-links-{name}")


def _index(
    documents: DataFrame, id_column: str, text_column: str, size: int, percent: int
) -> _Index:
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
    ).withColumn("tkey", text_key())
    summary = written(
        texts.mapInArrow(
            _summaries(size), "doc_id long, tkey long, n long, sid long, shingle long, often long"
        ),
        "jaccard-summary",
    )
    members = summary.filter("n is not null").select("doc_id", "tkey", "n", "sid")
    frequent = (
        summary.filter("often is not null")
        .groupBy("shingle")
        .agg(F.sum("often").alias("often"))
        .orderBy(F.desc("often"), "shingle")
        .limit(FREQUENT)
        .toPandas()
    )
    known = frequent["shingle"].to_numpy(np.int64).view(np.uint64)
    often = frequent["often"].to_numpy(np.int64)
    total = members.agg(F.sum("n")).first()[0] or 0
    by_hash = np.argsort(known)
    order = broadcast_value(
        documents.sparkSession,
        (
            known[by_hash],
            often[by_hash],
            pivots(max(0, total - int(often.sum())), often, FRAGMENTS),
        ),
    )
    maps = [f"b{k} long" for k in range(BITMAP_LONGS)]
    wide = [name for name, *_ in WIDE_BITMAPS]
    shapes = [*maps, *(f"{name} array<long>" for name in wide)]
    prefixes = written(
        texts.select("text").mapInArrow(
            _prefixes(size, percent, order),
            f"sid long, n long, {', '.join(shapes)}, prefix array<long>",
        ),
        "jaccard-prefixes",
    )
    # Copies of a set in other tasks have the same id, so a list counts only with two ids.
    starts = prefixes.select("sid", F.explode("prefix").alias("shingle"))
    shared = written(
        starts.groupBy("shingle")
        .agg(F.min("sid").alias("hub"), F.max("sid").alias("last"))
        .filter("hub <> last")
        .select("shingle", "hub"),
        "jaccard-shared",
    )
    whole = written(starts.join(shared.hint("merge"), "shingle").distinct(), "jaccard-whole")
    # Lists of the same sets, as all shingles of a shared passage have them, count once.
    chosen = (
        whole.groupBy("shingle")
        .agg(
            F.count("*").alias("sets"),
            F.bit_xor(F.xxhash64("sid")).alias("one"),
            F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("two"),
        )
        .groupBy("sets", "one", "two")
        .agg(F.min("shingle").alias("shingle"))
        .select("shingle")
    )
    lists = written(whole.join(chosen.hint("merge"), "shingle", "left_semi"), "jaccard-lists")
    listed = lists.select("sid").distinct()
    profile = written(
        prefixes.drop("prefix").join(small(listed, listed.count()), "sid").dropDuplicates(["sid"]),
        "jaccard-profiles",
    )
    narrow = profile.drop(*wide)
    owners = (
        members.join(listed, "sid")
        .groupBy("sid")
        .agg(F.min(F.struct("doc_id", "tkey")).alias("own"))
        .select("sid", "own.doc_id", "own.tkey")
    )
    return _Index(texts, members, lists, narrow, profile, owners, order, size, percent)


def jaccard_join(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = 5,
    percent: int = 80,
) -> tuple[DataFrame, DataFrame]:
    """All links, and the documents they are between.

    Links: one row (left_set, right_set, left_id, right_id, n_left, n_right, n_common) for every two
    different shingle sets with 100 * |intersection| >= percent * |union|, once, in the order of
    the smallest ids that have them (NULL last). Documents of one set are linked with each other
    without a row of their own.
    Members: one row (id, tkey, n_shingles, set_id, class_id, n_links) per document; class_id is the
    smallest id of its set, n_links the number of other documents it is linked with. Documents
    without shingles have no set and no links.

    There are as many link rows as links: in a group of k different texts up to k * (k - 1) / 2.
    """
    index = _index(documents, id_column, text_column, size, percent)
    full = index.lists.select("sid", "shingle").join(index.narrow, "sid")
    pairs = (
        full.alias("x")
        .join(
            full.alias("y"),
            (F.col("x.shingle") == F.col("y.shingle"))
            & (F.col("x.sid") < F.col("y.sid"))
            & _may_link("x", "y", percent),
        )
        .select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))
        .distinct()
    )
    found = index.confirmed(index.bounded(pairs, "all"), "all")
    classes = written(
        index.members.filter("n > 0")
        .groupBy("sid")
        .agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")),
        "jaccard-classes",
    )

    def of(side: str) -> DataFrame:
        return classes.select(
            F.col("sid").alias(side),
            F.col("class_id").alias(f"{side}_id"),
            F.col("copies").alias(f"{side}_copies"),
        )

    named = written(found.join(of("a"), "a").join(of("b"), "b"), "jaccard-named")
    least = F.when(F.col("a_id").eqNullSafe(F.col("b_id")), F.col("a") < F.col("b")).otherwise(
        F.coalesce(F.col("a_id") < F.col("b_id"), F.col("b_id").isNull())
    )
    ordered = {"set": ("a", "b"), "id": ("a_id", "b_id"), "n": ("n_a", "n_b")}

    def sided(name: str, side: str):
        first, second = ordered[name] if side == "left" else reversed(ordered[name])
        label = f"n_{side}" if name == "n" else f"{side}_{name}"
        return F.when(least, F.col(first)).otherwise(F.col(second)).alias(label)

    links = named.select(
        *(sided(name, side) for name in ordered for side in ("left", "right")),
        F.col("common").cast("long").alias("n_common"),
    )
    counted = (
        named.select(F.col("a").alias("sid"), F.col("b_copies").alias("others"))
        .union(named.select("b", "a_copies"))
        .groupBy("sid")
        .agg(F.sum("others").alias("others"))
    )
    classed = classes.join(counted, "sid", "left")
    members = index.members.join(classed, "sid", "left").select(
        F.col("doc_id").alias(id_column),
        "tkey",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("sid")).alias("set_id"),
        "class_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).alias("n_links"),
    )
    return links, members


def jaccard_components(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = 5,
    percent: int = 80,
    with_key: bool = False,
) -> DataFrame:
    """One row per document: id, number of shingles, and the smallest id reachable by links;
    ``with_key`` adds tkey, which tells rows of one id apart (see ``text_key``), and group, which
    tells groups apart whose rows have no id or one id.

    Two texts link when 100 * |intersection| >= percent * |union| of their shingle sets
    (``size`` words a shingle, A-Z lower-cased, words divided by blanks and control spaces).

    A short cut to the groups: pairs whose texts are in one group already are neither verified nor
    listed, so the links found here join all groups but are not all links; see ``jaccard_join``.
    """
    index = _index(documents, id_column, text_column, size, percent)
    members, lists, narrow, bounded = index.members, index.lists, index.narrow, index.bounded

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        return index.confirmed(pairs, name).select("a", "b")

    def grouping(edges: DataFrame, name: str) -> DataFrame:
        return components(edges, f"jaccard-{name}").withColumnRenamed("node", "sid")

    def of(groups: DataFrame, side: str) -> DataFrame:
        return groups.select(F.col("sid").alias(side), F.col("component").alias(f"{side}_group"))

    # Every set is first held against the one hub it shares most lists with, then against the
    # hubs of its lists that are still in other groups.
    shares = lists.filter("sid <> hub").groupBy("sid", "hub").count()
    best = shares.groupBy("sid").agg(F.max(F.struct("count", "hub")).alias("best"))
    star = best.select(F.col("best.hub").alias("a"), F.col("sid").alias("b"))
    links = confirmed(bounded(star, "best"), "best")
    groups = grouping(links, "groups")
    own = F.coalesce("component", "sid")
    split = (own != F.coalesce("hub_group", "hub")) & (F.col("sid") != F.col("hub"))
    apart = (
        lists.select("sid", "hub").distinct()
        .join(groups, "sid", "left").join(of(groups, "hub"), "hub", "left")
        .filter(split)
    )
    star = apart.select(F.col("hub").alias("a"), F.col("sid").alias("b"))
    links = links.union(confirmed(bounded(star, "hubs"), "hubs"))
    groups = grouping(links, "joined")
    # What is not in its hub's group is held against all of the list in other groups: first the
    # likeliest pair of every two groups, then every pair whose groups are still two.
    # Only lists with texts of two groups matter by now.
    grouped = written(
        lists.join(groups, "sid", "left").withColumn("component", own), "jaccard-grouped"
    )
    mixed = (
        grouped.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("shingle")
    )
    left = written(grouped.join(mixed.hint("merge"), "shingle", "left_semi"), "jaccard-mixed")
    listed = left.groupBy("sid").agg(F.array_sort(F.collect_list("shingle")).alias("shingles"))
    full = written(left.join(narrow, "sid").join(listed, "sid"), "jaccard-full")
    minor = full.join(of(groups, "hub"), "hub", "left").filter(split)
    rest = (
        minor.alias("x")
        .join(
            full.alias("y"),
            (F.col("x.shingle") == F.col("y.shingle"))
            & (F.col("x.component") != F.col("y.component"))
            & _may_link("x", "y", percent)
            & _first_in_common("x", "y"),
        )
        .select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b"))
        .distinct()
    )
    rest = bounded(rest, "rest")

    def still_two(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        both = pairs.join(of(groups, "a"), "a", "left").join(of(groups, "b"), "b", "left")
        first, second = F.coalesce("a_group", "a"), F.coalesce("b_group", "b")
        return both.withColumns(
            {"low": F.least(first, second), "high": F.greatest(first, second)}
        ).filter("low <> high")

    row = F.struct("flips", "a", "b", "n_a", "n_b")
    likeliest = still_two(rest, groups).groupBy("low", "high").agg(F.min(row).alias("pair"))
    links = links.union(confirmed(written(likeliest.select("pair.*"), "jaccard-likeliest"), "likeliest"))
    groups = grouping(links, "merged")
    last = written(still_two(rest, groups).drop("low", "high"), "jaccard-last")
    joined = grouping(links.union(confirmed(last, "last")), "components")
    named = members.join(joined, "sid", "left").withColumn(
        "component", F.coalesce("component", "sid")
    )
    smallest = written(
        named.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")),
        "jaccard-smallest",
    )
    return named.join(smallest, "component", "left").select(
        F.col("doc_id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *(["tkey", F.col("component").alias("group")] if with_key else []),
    )
