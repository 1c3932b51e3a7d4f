"""The corpus operators on small fixtures: brute force, NULLs, ties, repeats, empty tables, clashes."""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import (
    bpe,
    chunk_dedup,
    common,
    decontaminate,
    hilbert_shards,
    jaccard,
    language,
    perspectives,
    quality_rules,
    token_counts,
    url_rules,
)
from gaugeworks.llm.queries import VOCABULARY

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{k}" for k in range(60))
NEAR = BASE.replace("word30 ", "other ")
FAR = " ".join(f"else{k}" for k in range(60))
LONG = " ".join(f"w{k % 977}" for k in range(30_000))
# (id, text): NULLs, empty, short, copies, near copies, repeated rows, equal ids, very long.
ROWS = [
    (1, BASE),
    (2, NEAR),
    (3, BASE.upper()),
    (4, FAR),
    (5, ""),
    (6, None),
    (7, "two words"),
    (8, "Two  WORDS\n"),
    (9, "\t \n"),
    (None, BASE),
    (None, None),
    (10, FAR),
    (10, FAR),
    (11, LONG),
    (12, LONG + " end"),
    (13, "é" * 50 + " <|endoftext|> | # 漢字\x0bx\x1cy"),
    (13, "another text of the same id"),
    (14, f"{FAR[:200]} {BASE} tail"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names the operators use themselves."""
    frame = spark.createDataFrame(ROWS, SCHEMA).withColumns(
        {name: F.lit(f"own {name}") for name in CLASHES}
    )
    return frame.repartition(3)


CLASHES = ("sid", "tkey", "n", "hash", "shingle", "keys", "component", "cell", "bucket", "digest", "rank")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def rows_of(frame, *columns):
    return Counter(tuple(row) for row in frame.select(*columns).collect())


def test_jaccard_groups_equal_brute_force(docs):
    sets = [shingles(text) for _, text in ROWS]
    parent = list(range(len(ROWS)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(ROWS)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    want = Counter()
    for k, (name, _) in enumerate(ROWS):
        group = [n for j, (n, _) in enumerate(ROWS) if root(j) == root(k) and n is not None]
        want[name, len(sets[k]), min(group, default=None) if sets[k] else name] += 1
    got = jaccard.jaccard_components(docs)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == want


def test_jaccard_many_near_copies_of_one_text(spark):
    """A large group, its outliers and a common line: the groups of brute force."""
    texts = []
    for k in range(120):
        words = [f"w{j}" for j in range(80)]
        for j in range(k % 7):
            words[(k * 13 + j * 29) % 80] = f"x{k}_{j}"
        texts.append((k, " ".join(words)))
    line = " ".join(f"common{j}" for j in range(12))
    texts += [(200 + k, f"{line} " + " ".join(f"u{k}_{j}" for j in range(k % 30))) for k in range(90)]
    sets = {k: shingles(t) for k, t in texts}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in sets:
            if b < a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = jaccard.jaccard_components(spark.createDataFrame(texts, SCHEMA).repartition(5))
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(k, root(k)) for k in sets}


def joined(texts):
    """Brute force: links {(left, right): overlap} of different sets, and links per document."""
    sets = [(k, shingles(t)) for k, t in texts]
    classes = {}
    for k, s in sets:
        if s:
            classes.setdefault(frozenset(s), []).append(k)
    least = {s: min((k for k in ks if k is not None), default=None) for s, ks in classes.items()}
    near = {s: [] for s in classes}
    links = Counter()
    for a in classes:
        for b in classes:
            if a != b and 100 * len(a & b) >= 80 * len(a | b):
                near[a].append(b)
                if least[a] < least[b]:
                    links[least[a], least[b], len(a), len(b), len(a & b)] += 1
    members = Counter()
    for k, s in sets:
        others = near.get(frozenset(s), [])
        n_links = len(classes[frozenset(s)]) - 1 + sum(len(classes[o]) for o in others) if s else 0
        members[k, len(s), least[frozenset(s)] if s else None, n_links] += 1
    return links, members


LINK = ("left_id", "right_id", "n_left", "n_right", "n_common")
MEMBER = ("doc_id", "n_shingles", "class_id", "n_links")


def test_jaccard_join_equals_brute_force(docs):
    links, members = jaccard.jaccard_join(docs)
    want_links, want_members = joined(ROWS)
    assert want_links and rows_of(links, *LINK) == want_links
    assert rows_of(members, *MEMBER) == want_members


def test_jaccard_join_has_all_links_of_a_large_group(spark):
    """Links inside a group that a few of them already connect, with copies."""
    texts = []
    for k in range(120):
        words = [f"w{j}" for j in range(80)]
        if k % 4:
            words[(k * 13) % 80] = f"x{k}"
        texts.append((k, " ".join(words)))
    frame = spark.createDataFrame(texts, SCHEMA).repartition(5)
    links, members = jaccard.jaccard_join(frame)
    want_links, want_members = joined(texts)
    assert len(want_links) > 900 and rows_of(links, *LINK) == want_links
    assert rows_of(members, *MEMBER) == want_members


def test_jaccard_of_nothing(empty):
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_join_of_nothing(empty):
    assert [frame.count() for frame in jaccard.jaccard_join(empty)] == [0, 0]


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)]
    got = common.components(spark.createDataFrame(edges, "a long, b long"), "t")
    assert {(r.node, r.component) for r in got.collect()} == {(k, 0) for k in range(41)} | {
        (k, 100) for k in range(100, 130)
    }
    assert common.components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def test_token_counts_keep_rows_and_columns(docs, empty):
    pieces = token_counts.byte_vocabulary(VOCABULARY)
    got = token_counts.with_token_counts(docs, pieces)
    assert set(docs.columns) < set(got.columns) and got.count() == len(ROWS)
    found = {(r.doc_id, r.text): r for r in got.collect()}
    assert (found[6, None].n_words, found[6, None].n_tokens) == (0, 0)
    assert found[11, LONG].n_words == 30_000
    assert found[1, BASE].sid == "own sid"
    assert token_counts.with_token_counts(empty, pieces).count() == 0
    few = token_counts.with_token_counts(docs.filter("doc_id = 7"), [b" two", b" t"])
    assert few.first().n_tokens == 2  # one word spelled, one unknown


def test_quality_statistics_equal_brute_force(docs):
    want = Counter()
    for name, text in ROWS:
        words = WORD.findall(text or "")
        seen = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        inside = {
            k + j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(3)
        }
        lines = [line for line in (text or "").split("\n") if WORD.search(line)]
        want[
            name,
            len(words),
            sum(map(len, words)),
            sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)),
            len(inside),
        ] += 1
    got = quality_rules.with_statistics(docs)
    assert rows_of(got, "doc_id", *quality_rules.COUNTS) == want


def labelled(spark):
    def text(k, start):  # only the start of the words tells the kinds apart
        return " ".join(f"{start}{k:03d}{j:03d}" for j in range(60 + k % 40))

    good = [(k, text(k, "abc"), 1) for k in range(200)]
    marked = [(k, text(k, "ab#"), 0) for k in range(200, 260)]
    upper = [(k, text(k, "ABC"), 0) for k in range(260, 320)]
    rows = good + marked + upper
    texts = spark.createDataFrame([(k, t) for k, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame(
        [(k, q) for k, _, q in rows] + [(None, 0), (5, None), (9999, 0)], "doc_id long, quality int"
    )
    return texts, labels


def test_decision_list_separates_labels_and_orders_rules(spark):
    texts, labels = labelled(spark)
    rules = quality_rules.learn_rules(
        common.written(quality_rules.with_statistics(texts), "t"), labels
    )
    assert len(rules) == 2
    kept = quality_rules.keep_good(texts.withColumn("n_words", F.lit("mine")), rules)
    assert {r.doc_id for r in kept.collect()} == set(range(200))
    assert kept.columns == ["doc_id", "text", "n_words"] and kept.first().n_words == "mine"
    numbers = quality_rules.with_statistics(texts).select(
        quality_rules.rule_number(rules).alias("k"), (F.col("doc_id") < 260).alias("first")
    )
    assert {r.k for r in numbers.collect()} == {None, 1, 2}


def test_no_labels_no_rules(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rules = quality_rules.learn_rules(common.written(quality_rules.with_statistics(docs), "t"), none)
    assert rules == []
    assert quality_rules.keep_good(docs, rules).filter("text is null").count() == 0
    assert quality_rules.keep_good(empty, rules).count() == 0


URLS = [
    (1, "http://example.com/en/1"),
    (2, "https://WWW.example.com/en/?q#f"),
    (3, "http://m.www.example.com/en/x"),
    (4, "http://notexample.com/en/"),
    (5, "http://a.net/es/1"),
    (6, "http://a.net/ES/1"),
    (7, "http://com"),
    (8, None),
    (9, "no scheme"),
    (10, ""),
    (11, "http://a.com:80/"),
    (12, "http://x.com?a=://b.net/fr/"),
    (13, "http://a.net/fr/1"),
    (13, "http://a.net/fr/1"),
    (None, "http://example.com/en"),
    (14, "x://İ.COM/en/\n?"),
]


def test_url_verdicts_equal_brute_force(spark):
    from gaugeworks.llm.queries import URL_RULES

    want = Counter()
    for name, url in URLS:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = re.search(r"[/?#]", rest)
            host = (rest[: cut.start()] if cut else rest).translate(LOWER)
            path = re.split(r"[?#]", rest[cut.start() :] if cut else "", maxsplit=1)[0]
        fits = [
            (len(rule), rule, verdict)
            for rule, verdict in URL_RULES
            for h, _, p in [rule.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)
        ]
        best = max(fits, default=(0, None, "allow"))
        want[name, host, path, best[1], best[2]] += 1
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("regex", F.lit("(own"))
    got = url_rules.judge_urls(pages, URL_RULES)
    assert rows_of(got, "page_id", "host", "path", "rule", "verdict") == want
    assert {r.regex for r in got.collect()} == {"(own"}
    assert url_rules.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_url_rules_with_wildcards_open_ends_and_without_tokens(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.org/x/ads/y"), (2, "http://a.org/adverts"), (3, "http://b.org/z")],
        "page_id long, url string",
    )
    rules = [("org/*/ads/", "block"), ("a.org/adv", "block"), ("é/", "block"), ("b.org", "block")]
    got = {r.page_id: r.rule for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {1: "org/*/ads/", 2: "a.org/adv", 3: "b.org"}


def test_chunk_dedup_keeps_the_first_and_cuts_the_rest(docs, empty):
    got = chunk_dedup.deduplicate_chunks(docs)
    found = [r.asDict() for r in got.collect()]
    assert len(found) == len(ROWS) and set(docs.columns) < set(got.columns)
    by = {}
    for row in found:
        by.setdefault(row["doc_id"], []).append(row)
    assert by[1][0]["text"] == BASE and by[1][0]["removed_spans"] == []
    assert by[6][0]["text"] is None and by[5][0]["text"] == ""
    assert len(by[14][0]["text"]) < 200 and set(by[14][0]["repeat_of"]) == {1, 4}
    assert [r["text"] for r in by[10]] == ["", ""]  # both rows of id 10 repeat document 4
    assert by[4][0]["text"] == FAR and len(by[12][0]["text"]) < 1000
    assert by[7][0]["text"] == "two words"
    for row in found:
        source = next(t for n, t in ROWS if n == row["doc_id"] and (t is None) == (row["text"] is None))
        assert row["text"] is None or set(row["text"].split()) <= {
            w for n, t in ROWS if n == row["doc_id"] for w in (t or "").split()
        } or source is None
    assert chunk_dedup.deduplicate_chunks(empty).count() == 0


def test_chunk_dedup_equals_brute_force(docs):
    """Repeated means: an earlier id has the two chunks side by side (or a long one), or the same
    text has them earlier. Told from the bytes of the chunks."""
    chunked = []
    for name, text in ROWS:
        data = (text or "").encode()
        ends = [0, *chunk_dedup.chunk_block([data])[0][0].tolist()]
        chunks = [data[a:b] for a, b in zip(ends, ends[1:])]
        pairs = [*zip(chunks, chunks[1:]), *((c,) for c in chunks if len(c) >= 96)]
        chunked.append((name, chunks, pairs))
    want = Counter()
    for name, chunks, pairs in chunked:
        if name is None:
            continue
        known = {p for other, _, theirs in chunked if other is not None and other < name for p in theirs}
        spans, again, at, k = [], 0, 0, 0
        while k < len(chunks):
            end = k
            while end + 1 < len(chunks) and (
                (pair := (chunks[end], chunks[end + 1])) in known or pair in pairs[:end]
            ):
                end += 1
            size = sum(map(len, chunks[k : end + 1]))
            long = (chunks[k],) in known or chunks[k] in chunks[:k]
            if size >= 96 and (end > k or long):
                again += end + 1 - k
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + size)
                else:
                    spans.append((at, at + size))
            at, k = at + size, end + 1
        want[name, len(chunks), again, tuple(spans)] += 1
    # Rows without an id are ordered by a hash; they hold copies of document 1 and nothing else.
    named = docs.filter("doc_id is not null")
    got = Counter(
        (r.doc_id, r.n_chunks, r.n_repeated, tuple((s.start, s.end) for s in r.removed_spans))
        for r in chunk_dedup.deduplicate_chunks(named).collect()
    )
    assert got == want


def test_bpe_round_trip_keeps_rows_and_columns(docs, empty):
    from tokenizers import Tokenizer

    library, read = Tokenizer.from_file(VOCABULARY), bpe.read_vocabulary(VOCABULARY)
    got = bpe.with_decoded_text(bpe.with_token_ids(docs, read), read)
    assert got.count() == len(ROWS) and set(docs.columns) < set(got.columns)
    for row in got.collect():
        assert row.token_ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "")
    assert bpe.with_token_ids(empty, read).count() == 0


TURNS = [
    (1, 0, "system", "Be kind"),
    (1, 1, "ann", "hi <|end|>"),
    (1, 2, "bob", None),
    (1, 3, "ann", "bye"),
    (2, None, None, "who"),
    (2, 1, "ann", "me"),
    (2, 1, "ann", "me"),
    (None, 5, "eve", "lost"),
    (3, 0, "system", "only"),
] + [(4, k, "ab"[k % 2], str(k)) for k in range(200)]


def test_every_speaker_gets_every_turn_of_the_dialogue(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = [r.asDict(True) for r in perspectives.rotate_perspectives(turns.repartition(3)).collect()]
    want = Counter()
    for conv, _, _, _ in TURNS:
        for speaker in {r for c, _, r, _ in TURNS if c == conv} - {None, "system"}:
            want[conv, speaker] += 1
    assert {k: sum(r["n_turns"] for r in got if (r["conv_id"], r["speaker"]) == k) for k in want} == want
    one = next(r for r in got if (r["conv_id"], r["speaker"]) == (1, "ann"))
    assert one["rendered"] == (
        "<|system|>\nBe kind<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user bob|>\n<|end|>\n"
        "<|assistant|>\nbye<|end|>\n"
    )
    said = [one["rendered"][s["start"] : s["end"]] for s in one["mask"]]
    assert said == ["hi < |end|><|end|>", "bye<|end|>"]
    long = sorted((r["part"], r["n_turns"]) for r in got if (r["conv_id"], r["speaker"]) == (4, "a"))
    assert [part for part, _ in long] == list(range(len(long))) and len(long) == -(-sum(n for _, n in long) // 64)
    for conv, speaker in {(r["conv_id"], r["speaker"]) for r in got}:
        own = sorted(
            (r for r in got if (r["conv_id"], r["speaker"]) == (conv, speaker)), key=lambda r: r["part"]
        )
        whole = "".join(r["rendered"] for r in own)
        assert [r["start"] for r in own] == [
            sum(len(r["rendered"]) for r in own[:k]) for k in range(len(own))
        ]
        said = [whole[s["start"] : s["end"]] for r in own for s in r["mask"]]
        assert len(said) == sum(c == conv and r == speaker for c, _, r, _ in TURNS)
        assert all(text.endswith("<|end|>") for text in said)
    assert max(r["n_turns"] for r in got) <= perspectives.TURNS_PER_PART
    assert not [r for r in got if r["conv_id"] == 3]
    assert perspectives.rotate_perspectives(turns.limit(0)).count() == 0


def test_numbers_of_turns_do_not_matter(spark):
    rows = [(1, 100 * k, "ab"[k % 2], f"t{k}") for k in range(4)]
    rows += [(2, 1_700_000_000 + 7919 * k, "ab"[k % 2], f"t{k}") for k in range(200)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = perspectives.rotate_perspectives(turns.repartition(3)).collect()
    assert sorted((r.speaker, r.n_turns) for r in got if r.conv_id == 1) == [("a", 4), ("b", 4)]
    parts = sorted((r for r in got if (r.conv_id, r.speaker) == (2, "a")), key=lambda r: r.part)
    assert [r.n_turns for r in parts] == [64, 64, 64, 8]
    whole = "".join(r.rendered for r in parts)
    said = [whole[s.start : s.end] for r in parts for s in r.mask]
    assert said == [f"t{k}<|end|>" for k in range(0, 200, 2)]


def test_equal_turn_numbers_are_split_into_parts(spark):
    turns = spark.range(150).selectExpr("1L conv_id", "7L turn", "'x' role", "cast(id as string) text")
    got = perspectives.rotate_perspectives(turns).collect()
    assert sorted(r.n_turns for r in got) == [22, 64, 64]


def test_hilbert_curve_visits_neighbours(spark):
    bits, size = 2, 4
    cells = spark.range(size**3).withColumn(
        "h", hilbert_shards.hilbert_index(F.col("id"), 3, bits)
    )
    order = [r.id for r in sorted(cells.collect(), key=lambda r: r.h)]
    assert sorted(r.h for r in cells.collect()) == list(range(size**3))
    points = [(k // 16, k // 4 % 4, k % 4) for k in order]
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(points, points[1:]))


def test_shards_are_even_gapless_and_narrow(spark, monkeypatch, docs, empty):
    monkeypatch.setattr(hilbert_shards, "BUCKET_ROWS", 50)
    rows = spark.range(0, 1000, 1, 1).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 10 END a", "(id * 7919) % 1000 b", "'own' shard"
    )
    got = hilbert_shards.assign_shards(rows, {"a": F.col("a"), "b": F.col("b")}, 24, tie=["id"])
    by = {}
    for r in got.collect():
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(24)) and {len(v) for v in by.values()} == {41, 42}
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    spread = sum(max(r.b for r in v) - min(r.b for r in v) for v in by.values()) / 24
    assert spread < 600
    again = hilbert_shards.assign_shards(
        rows.repartition(7), {"a": F.col("a"), "b": F.col("b")}, 24, tie=["id"]
    )
    assert rows_of(got, "id", "shard", "slot") == rows_of(again, "id", "shard", "slot")
    few = docs.select("doc_id", "text", F.length("text").alias("size"), "cell", "rank")
    placed = hilbert_shards.assign_shards(few, {"x": F.col("size")}, 24, tie=["doc_id", "text"])
    assert placed.count() == len(ROWS) and set(few.columns) < set(placed.columns)
    assert len({(r.shard, r.slot) for r in placed.collect()}) == len(ROWS)
    none = hilbert_shards.assign_shards(empty, {"x": F.length("text")}, 24, tie=["doc_id"])
    assert none.count() == 0


def test_contamination_equals_brute_force(spark, docs, empty):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return pattern.findall((text or "").translate(LOWER))

    items = [
        (1, " ".join(f"word{k}" for k in range(20, 33))),
        (2, "TWO words"),
        (3, "two-words"),
        (4, None),
        (5, "..."),
        (6, " ".join(f"w{k}" for k in range(970, 980))),
        (7, "same id"),
        (None, "éé"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit("own"))
    want = Counter()
    for name, text in ROWS:
        own, hit, found = words(text), set(), set()
        for number, item in items:
            theirs = words(item)
            size = min(10, len(theirs))
            windows = {tuple(theirs[a : a + size]) for a in range(len(theirs) - size + 1)} if size else set()
            for b in range(len(own) - size + 1 if size else 0):
                if tuple(own[b : b + size]) in windows:
                    hit |= set(range(b, b + size))
                    found.add(str(number))
        want[name, len(own), tuple(sorted(hit)), tuple(sorted(found - {"None"}))] += 1
    got = decontaminate.contamination(docs, bench)
    assert (
        Counter((r.doc_id, r.n_words, tuple(r.hit_words), tuple(r.items)) for r in got.collect()) == want
    )
    assert decontaminate.contamination(empty, bench).count() == 0
    clean = decontaminate.contamination(docs, bench.limit(0))
    assert clean.filter("size(hit_words) > 0").count() == 0 and clean.count() == len(ROWS)


def test_language_is_learnt_and_held_out(spark, sf_dir, docs):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    filters = language.learn_languages(documents.filter(~held))
    got = language.with_language(documents.filter(held), filters)
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "é")], SCHEMA)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.with_language(odd, filters).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[4][0] != "und"
    kept = language.with_language(docs, filters)
    assert kept.count() == len(ROWS) and set(docs.columns) < set(kept.columns)
    assert {True} == {0 <= r.score <= 1 for r in kept.collect()}
    nothing = language.learn_languages(documents.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.with_language(docs, nothing).collect()} == {"und"}


def test_checksums_are_those_of_zlib(spark):
    row = spark.sql("select crc32(cast('42' as binary)) c").first()
    assert row.c == zlib.crc32(b"42")


def test_a_common_phrase_makes_no_candidates(spark, monkeypatch):
    """A phrase shorter than the span, in all documents and items, and one real passage."""
    phrase = "as it was said before this"

    def text(name, n):
        words = [f"{name}{n}x{k}" for k in range(24)]
        return " ".join([*words[:12], phrase, *words[12:]])

    documents = spark.createDataFrame([(n, text("d", n)) for n in range(60)], SCHEMA)
    bench = spark.createDataFrame(
        [(n, text("i", n)) for n in range(60)] + [(99, text("d", 7))], "item_id long, text string"
    )
    compared = []
    plain = decontaminate.written

    def counted(frame, label):
        stored = plain(frame, label)
        if label == "winnow-pairs":
            compared.append(stored.select(F.sum(F.size("keys"))).first()[0])
        return stored

    monkeypatch.setattr(decontaminate, "written", counted)
    got = decontaminate.contamination(documents, bench).collect()
    assert {r.doc_id: r["items"] for r in got if r["items"]} == {7: ["99"]}
    assert compared == [1]
