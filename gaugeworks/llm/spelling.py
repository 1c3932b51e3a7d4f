"""Spelling variants of a corpus's words through a trie of letter-group counts.

Letters are dealt into groups; a word becomes the vector of how often it has letters of each
group. The vectors form a trie, one group a level. One inserted, deleted or replaced letter changes the
vector by a surplus of one at most and a deficit of one at most, so a depth-first search that may
spend one of each reaches every near word; the words at the leaves it reaches are verified.

The trie is cut into shards: the words below a node, as soon as they are few enough. Only the
nodes above the cuts are known to all tasks, their number is that of the words over the shard size, times
the children of a node. Each word visits the shards that it can reach; a shard with too many visitors,
or a single vector with too many words, is dealt out over several tasks.

Edge cases: NULL texts have no words; a NULL id counts as an empty one in the checksum; very long
words take part like others; repeated rows count as often as they stand there; ties of counts go to the
smallest word in code-point order; columns beside id and text are not read, whatever their names; an
empty table has no words.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import broadcast_value, written

# Levels of the trie.
GROUPS = 12

# Words of a shard, and visitors that search it in one task.
SHARD_WORDS = 1 << 15
VISITORS = 1 << 17

# Fewer words below a node are compared with the visitors' whole vectors at once.
FEW = 24

# Letters up to which words are compared as rows of one array, and pairs compared at once.
WIDE = 40
TOGETHER = 1 << 16

# Distinct words that a task counts before it hands them on; bounds the memory, not the result.
COUNTED = 1 << 18

_LETTERS = [chr(code) for code in (*range(0x61, 0x7B), *range(0x41, 0x5B), *range(0xC0, 0x100))]

# What stands for each Latin-1 byte when words are cut out: A-Z folded, a blank for all but letters.
_FOLD = bytes(
    code + 32 if 0x41 <= code < 0x5B else code if 0x61 <= code < 0x7B or code >= 0xC0 else 0x20
    for code in range(256)
)


def words_of(text: str) -> list[bytes]:
    """The runs of letters of a text, A-Z folded, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def spoiled(word: bytes, name: bytes, every: int) -> bytes:
    """The word, without one letter if the checksum of document and word asks for it."""
    check = zlib.crc32(_utf8(word), zlib.crc32(name + b":"))
    if check % every:
        return word
    at = check % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    documents: DataFrame,
    spoil_every: int = 0,
    least_letters: int = 5,
    least_count: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The words (word, n) of all whole texts with enough letters and occurrences.

    With ``spoil_every`` k, one of k pairs of document and word loses a letter before the count.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)

        def counted() -> pa.RecordBatch:
            words = [word.decode("latin-1") for word in total]
            numbers = pa.array(total.values(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), numbers], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                name = (key.as_py() or "").encode()
                for word, times in Counter(words_of(text.as_py() or "")).items():
                    if spoil_every:
                        word = spoiled(word, name, spoil_every)
                    if len(word) >= least_letters:
                        total[word] += times
                if len(total) >= COUNTED:
                    yield counted()
                    total.clear()
        yield counted()

    named = documents.select(F.col(id_column).cast("string"), F.col(text_column))
    return (
        named.mapInArrow(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least_count)
    )


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[int]:
    """The group of each Latin-1 letter: by falling frequency, dealt out in turn."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter")
    counts = {row.letter: row.times for row in letters.agg(F.count("*").alias("times")).collect()}
    order = sorted(_LETTERS, key=lambda letter: (-counts.get(letter, 0), letter))
    group = [0] * 256
    for place, letter in enumerate(order):
        group[ord(letter)] = place % groups
    return group


def vectors(words: list[str], group: list[int], groups: int) -> np.ndarray:
    """One row of letter-group counts per word."""
    sizes = [len(word) for word in words]
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    place = np.repeat(np.arange(len(words)), sizes) * groups + np.array(group)[letters]
    return np.bincount(place, minlength=len(words) * groups).reshape(len(words), groups)


def near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def letter_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of each word up to ``WIDE``, padded with zeros, and the words' lengths."""
    sizes = np.array([len(word) for word in words])
    text = "".join(word[:WIDE].ljust(WIDE, "\x00") for word in words)
    rows = np.frombuffer(text.encode("latin-1"), np.uint8).reshape(len(words), WIDE)
    return rows, sizes


def are_near(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``near`` for rows of letters; words longer than ``WIDE`` count as not near."""
    (a, size_a), (b, size_b) = a, b
    fits = (np.abs(size_a - size_b) <= 1) & (np.maximum(size_a, size_b) <= WIDE)
    differ = a != b
    found = fits & (size_a == size_b) & (differ.sum(1) == 1)
    # One letter more: the words agree up to a place, and from there on shifted by one.
    first = np.where(differ.any(1), differ.argmax(1), WIDE)
    for longer, shorter, more in ((a, b, size_a - size_b), (b, a, size_b - size_a)):
        one = np.flatnonzero(fits & (more == 1))
        shifted = longer[one, 1:] != shorter[one, :-1]
        last = np.where(shifted.any(1), WIDE - 1 - shifted[:, ::-1].argmax(1), 0)
        found[one] = last <= first[one]
    return found


def verified(names: list[str], asking: list[str], pairs: Iterator) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (visitors, members) of leaf words that are near, checked many at a time."""
    mine, theirs = letter_rows(asking), letter_rows(names)
    short = [np.array([len(word) <= WIDE for word in words]) for words in (asking, names)]
    kept_who, kept_which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    some: list[tuple[np.ndarray, np.ndarray]] = []

    def check() -> None:
        who = np.concatenate([pair[0] for pair in some])
        which = np.concatenate([pair[1] for pair in some])
        some.clear()
        good = are_near((mine[0][who], mine[1][who]), (theirs[0][which], theirs[1][which]))
        for k in np.flatnonzero(~(short[0][who] & short[1][which])).tolist():
            good[k] = near(asking[who[k]], names[which[k]])
        kept_who.append(who[good])
        kept_which.append(which[good])

    waiting = 0
    for pair in pairs:
        some.append(pair)
        waiting += len(pair[0])
        if waiting >= TOGETHER:
            check()
            waiting = 0
    if some:
        check()
    return np.concatenate(kept_who), np.concatenate(kept_which)


def _prefixes(words: DataFrame, group: list[int], groups: int) -> DataFrame:
    """The words with their vectors as text, so that the path to a node is a prefix."""

    def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = vectors(batch.to_pylist(), group, groups).tolist()
            yield pa.array([",".join(map(str, row)) for row in rows], pa.string())

    spelled = F.arrow_udf(spell, "string", F.ArrowUDFType.SCALAR_ITER)
    return words.select("word", "n", spelled(F.col("word")).alias("vector"))


def shards(vectored: DataFrame, groups: int, most: int = SHARD_WORDS) -> list[tuple[str, int]]:
    """The cuts of the trie: nodes (paths) with at most ``most`` words or a whole vector, and their words."""
    cuts: list[tuple[str, int]] = []
    heavy = None
    for depth in range(1, groups + 1):
        rows = vectored.select(
            F.substring_index("vector", ",", depth - 1).alias("above"),
            F.substring_index("vector", ",", depth).alias("path"),
        )
        if heavy is not None:
            rows = rows.filter(F.col("above").isin(heavy))
        # Nodes of one level below heavy ones only.
        level = rows.groupBy("path").agg(F.count("*").alias("words")).collect()
        heavy = [row.path for row in level if row.words > most and depth < groups]
        cuts += [(row.path, row.words) for row in level if row.words <= most or depth == groups]
        if not heavy:
            break
    return sorted(cuts)


def _top(cuts: list[tuple[str, int]]) -> dict:
    """The nodes above the cuts: nested maps from count to node, the number of a cut at the end."""
    root: dict = {}
    for number, (path, _) in enumerate(cuts):
        *above, last = map(int, path.split(","))
        node = root
        for count in above:
            node = node.setdefault(count, {})
        node[last] = number
    return root


def reached(node, counts: list[int], surplus: int = 1, deficit: int = 1) -> Iterator[int]:
    """The cuts that a vector can reach with its budget, depth first."""
    if isinstance(node, int):
        yield node
        return
    count, rest = counts[0], counts[1:]
    for child, spend in ((count, (0, 0)), (count + 1, (1, 0)), (count - 1, (0, 1))):
        if child in node and spend[0] <= surplus and spend[1] <= deficit:
            yield from reached(node[child], rest, surplus - spend[0], deficit - spend[1])


def leaves(
    members: np.ndarray, visitors: np.ndarray, few: int = FEW
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (visitors, members) whose vectors differ by a surplus and a deficit of one at most.

    The rows of ``members`` are sorted, so the words below a node of the trie lie together. The search
    goes depth first and takes all visitors that can afford a node along.
    """
    levels = members.shape[1]
    budget = np.ones(len(visitors), np.int64)
    stack = [(0, len(members), 0, np.arange(len(visitors)), budget, budget)]
    while stack:
        low, high, level, who, surplus, deficit = stack.pop()
        if not len(who):
            continue
        if level == levels or high - low <= few:
            rest = members[low:high, level:][None] - visitors[who, level:][:, None]
            fits = (np.maximum(rest, 0).sum(2) <= surplus[:, None]) & (
                np.maximum(-rest, 0).sum(2) <= deficit[:, None]
            )
            a, b = np.nonzero(fits)
            yield who[a], b + low
            continue
        column = members[low:high, level]
        cuts = np.flatnonzero(np.diff(column)) + 1
        mine = visitors[who, level]
        for start, end in zip([0, *cuts], [*cuts, high - low]):
            more = column[start] - mine
            left = surplus - np.maximum(more, 0)
            short = deficit - np.maximum(-more, 0)
            some = np.flatnonzero((left >= 0) & (short >= 0))
            stack.append((low + start, low + end, level + 1, who[some], left[some], short[some]))


def _search(group: list[int], groups: int):
    """Finds, in one shard, the near words of its visitors: their number and the commonest."""
    schema = pa.schema(
        [("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]
    )

    def search(members: pa.Table, visitors: pa.Table) -> pa.Table:
        names, counts = members["word"].to_pylist(), members["n"].to_pylist()
        asking = visitors["visitor"].to_pylist()
        if not names or not asking:
            return schema.empty_table()
        trie = vectors(names, group, groups)
        order = np.lexsort(trie.T[::-1])
        names = [names[k] for k in order]
        counts = [counts[k] for k in order]
        reached_pairs = leaves(trie[order], vectors(asking, group, groups))
        who, which = verified(names, asking, reached_pairs)
        # The commonest near word of each visitor first, of equal ones the smallest.
        place = np.empty(len(names), np.int64)
        place[sorted(range(len(names)), key=lambda k: (-counts[k], names[k]))] = range(len(names))
        by_place = np.lexsort((place[which], who))
        visitor, first, number = np.unique(who[by_place], return_index=True, return_counts=True)
        best = which[by_place][first].tolist()
        return pa.table(
            {
                "word": [asking[k] for k in visitor.tolist()],
                "n_near": number,
                "form": [names[k] for k in best],
                "form_n": [counts[k] for k in best],
            },
            schema,
        )

    return search


def near_words(
    words: DataFrame, groups: int = GROUPS, most: int = SHARD_WORDS, visits: int = VISITORS
) -> DataFrame:
    """Every word (word, n) with its near words: n_near, and the commonest one (form, form_n)."""
    spark = words.sparkSession
    group = letter_groups(words, groups)
    vectored = written(_prefixes(words, group, groups), "spelling-vectors")
    cuts = shards(vectored, groups, most)
    shared = broadcast_value(spark, _top(cuts))

    def route(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        top = shared.value
        for batch in batches:
            homes, reach = [], []
            for vector in batch.to_pylist():
                counts = list(map(int, vector.split(",")))
                homes.append(next(reached(top, counts, 0, 0)))
                reach.append(list(reached(top, counts)))
            yield pa.StructArray.from_arrays(
                [pa.array(homes, pa.int32()), pa.array(reach, pa.list_(pa.int32()))], ["home", "reach"]
            )

    routing = F.arrow_udf(route, "home int, reach array<int>", F.ArrowUDFType.SCALAR_ITER)
    routed = written(
        vectored.select("word", "n", routing(F.col("vector")).alias("to")).select("word", "n", "to.*"),
        "spelling-routes",
    )
    arriving = routed.select(F.explode("reach").alias("shard"), F.col("word").alias("visitor"))
    # Rows of a shard: members in parts, and visitors in parts; each part meets each part.
    sizes = arriving.groupBy("shard").agg(F.count("*").alias("visitors")).collect()
    parts = {row.shard: (-(-cuts[row.shard][1] // most), -(-row.visitors // visits)) for row in sizes}
    halves = {shard: pair for shard, pair in parts.items() if pair != (1, 1)}

    def dealt(frame: DataFrame, name: str, own: int) -> DataFrame:
        """The rows with the parts they belong to: one by a hash, times all of the other side."""
        if not halves:
            return frame.withColumn("own", F.lit(0)).withColumn("other", F.lit(0))
        known = F.broadcast(
            spark.createDataFrame(
                [(k, pair[own], pair[1 - own]) for k, pair in halves.items()],
                "dealt int, own_parts int, other_parts int",
            )
        )
        joined = frame.join(known, F.col("shard") == F.col("dealt"), "left")
        own_part = F.pmod(F.xxhash64(name), F.coalesce("own_parts", F.lit(1))).cast("int")
        others = F.sequence(F.lit(0), F.coalesce("other_parts", F.lit(1)) - 1)
        return (
            joined.withColumn("own", own_part)
            .withColumn("other", F.explode(others))
            .drop("dealt", "own_parts", "other_parts")
        )

    members = dealt(routed.select(F.col("home").alias("shard"), "word", "n"), "word", 0)
    visitors = dealt(arriving, "visitor", 1)
    found = (
        members.groupBy("shard", F.col("own").alias("a"), F.col("other").alias("b"))
        .cogroup(visitors.groupBy("shard", F.col("other").alias("a"), F.col("own").alias("b")))
        .applyInArrow(
            _search(group, groups), "word string, n_near bigint, form string, form_n bigint"
        )
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return words.join(summed, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.col("best")["form"].alias("form"),
        (-F.col("best")["less"]).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row (word, form) with a form: the end of its chain of forms.

    Every round lets each word follow what its present end follows, so chains halve; counts grow along a
    chain, so there is no ring.
    """
    formed = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    ends = written(formed, "spelling-0")
    step = 0
    while True:
        step += 1
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = written(
            ends.join(onward, "root", "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            f"spelling-{step}",
        )
        moved = ends.filter("moved").limit(1).count()
        ends = ends.select("word", "root")
        if not moved:
            return ends


def spelling_variants(words: DataFrame, times: int = 2) -> DataFrame:
    """Each word (word, n) with its form, root and near words.

    The form is the commonest near word, if it is ``times`` as common as the word at least; the root
    is the last form of the chain, the word itself if it has none.
    """
    words = written(words.select("word", "n"), "spelling-words")
    found = near_words(words)
    common = F.col("form_n") >= times * F.col("n")
    formed = written(
        found.withColumns(
            {
                "form": F.when(common, F.col("form")),
                "form_n": F.when(common, F.col("form_n")),
            }
        ),
        "spelling-forms",
    )
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
