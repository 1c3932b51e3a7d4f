"""Registered queries without SQL against independent brute force over the whole test table, and
the pipeline's stages on odd rows."""

from __future__ import annotations

import json
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from gaugeworks.llm import chunk_dedup  # noqa: E402
from gaugeworks.llm.queries import queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return {row.doc_id: row.text for row in rows}


def test_token_counts_are_greedy_longest_matches(spark, texts):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand_in = {b: chr(b) for b in plain}
    stand_in |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
    longest = max(map(len, pieces))
    known = {}

    def count(word):
        if word not in known:
            rest, total = "".join(stand_in[b] for b in b" " + word.encode()), 0
            while rest:
                size = next(n for n in range(min(longest, len(rest)), 0, -1) if rest[:n] in pieces)
                rest, total = rest[size:], total + 1
            known[word] = total
        return known[word]

    for row in queries()["op1_token_counts"](spark, SF_DIR).collect():
        words = WORD.findall(texts[row.doc_id] or "")
        assert (row.n_words, row.n_tokens) == (len(words), sum(map(count, words)))


def test_quality_statistics_and_verdicts(spark):
    folder = "/root/testdata/sf0.01"  # the smallest table has too few labels to learn from
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    texts = {row.doc_id: row.text for row in rows}
    labels = {}
    for row in spark.read.parquet(f"{folder}/labels.parquet").collect():
        labels.setdefault(row.doc_id, row.quality)
    good = Counter()
    for row in queries()["op2_quality_rules"](spark, folder).collect():
        text = texts[row.doc_id] or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        inside = set()
        for k in range(len(words) - 2):
            if windows[tuple(words[k : k + 3])] > 1:
                inside |= {k, k + 1, k + 2}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(inside)
        assert row.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
        # The verdict: rejected by the base, or by exactly one rule of the list.
        assert row.kept == (not row.base_failed and row.rule is None)
        good[labels.get(row.doc_id), row.kept] += 1
    assert good[0, True] <= 0.1 * good[0, False]
    assert good[1, False] <= 0.1 * good[1, True]


def test_passages_are_cut_where_an_earlier_text_has_them(spark, texts):
    earlier: dict[bytes, set] = defaultdict(set)
    chunked = {}
    for key in sorted(texts):
        data = (texts[key] or "").encode()
        ends = [0, *chunk_dedup.chunk_block([data])[0][0].tolist()]
        chunked[key] = [data[a:b] for a, b in zip(ends, ends[1:])], ends
        for part in zip(chunked[key][0], chunked[key][0][1:]):
            earlier[b"".join(part)].add(key)
    for row in queries()["op4_substring_dedup"](spark, SF_DIR).collect():
        chunks, ends = chunked[row.doc_id]
        data = (texts[row.doc_id] or "").encode()
        rest, inside = data, 0
        for span in reversed(row.removed_spans):
            assert span.end - span.start >= chunk_dedup.MIN_RUN
            rest = rest[: span.start] + rest[span.end :]
            first, last = ends.index(span.start), ends.index(span.end)
            inside += last - first
            for k in range(first, last - 1):
                pair = chunks[k] + chunks[k + 1]
                before = {other for other in earlier[pair] if other < row.doc_id}
                assert before or data.find(pair) < ends[k] or len(chunks[k]) >= chunk_dedup.MIN_RUN
        assert (row.text or "").encode() == rest
        assert row.n_chunks == len(chunks) and row.n_repeated == inside


def test_shards_are_even_and_narrow_in_every_dimension(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = queries()["op7_hilbert_shards"](spark, "/root/testdata/sf0.01")
    both = placed.join(rows.select("doc_id", "lang", "source", "text"), "doc_id").collect()
    sizes = Counter(row.shard for row in both)
    assert sorted(sizes) == list(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    by = defaultdict(list)
    for row in both:
        by[row.shard].append(row)
        assert row["size"] == len((row.text or "").encode()) + 8
    for shard in by.values():
        assert sorted(row.slot for row in shard) == list(range(len(shard)))
    spread = {
        name: sum(len({row[name] for row in shard}) for shard in by.values()) / 24
        for name in ("lang", "source")
    }
    assert spread["lang"] <= 2.5 and spread["source"] <= 0.6 * len({row.source for row in both})


def test_languages_and_texts_without_letters(spark, tmp_path):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [(1000 + k, text) for k, text in enumerate(["a", "x 1", "I.", "é", "1 2", "", None, "漢"])]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    documents.unionByName(more, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    langs = {row.doc_id: row.lang for row in documents.collect()}
    right = total = 0
    for row in queries()["op9_language_id"](spark, str(tmp_path)).collect():
        assert 0 <= row.score <= 1
        if row.doc_id >= 1000:
            text = dict(odd)[row.doc_id]
            assert (row.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
        elif row.held_out and langs[row.doc_id]:
            total += 1
            right += row.lang_pred == langs[row.doc_id]
    assert total and right >= 0.95 * total


STAGES = dict(corpus_pipeline.STAGES)
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], SHAPE)


def prose(name, words=60):
    return " ".join(f"{name}{k}" for k in range(words))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    rows = [(1, prose("a")), (1, prose("a")), (None, prose("b")), (None, prose("b")), (2, None), (None, None)]
    rows += [(3, ""), (4, " \n"), (5, prose("long", 30_000)), (6, "short"), (6, prose("c"))]
    docs = odd_documents(spark, rows)
    got = STAGES[name](spark, docs.repartition(3), SF_DIR)
    kept = [(row.doc_id, getattr(row, "text", "-")) for row in got.collect()]
    if name == "token_ids":
        assert len(kept) == len(rows) and all(row.round_trip for row in got.collect())
        return
    assert got.columns == docs.columns
    assert set(kept) <= set(rows) | {(None, ""), (1, "")}
    if name == "quality":
        assert Counter(kept) == Counter((k, t) for k, t in rows if t and len(t.split()) >= 50)
    if name == "near_duplicates":
        assert Counter(kept)[1, prose("a")] == Counter(kept)[None, prose("b")] == 1
        assert len(kept) == len(rows) - 2
    if name == "benchmark_leaks":
        assert Counter(kept) == Counter(rows)
    assert STAGES[name](spark, docs.limit(0), SF_DIR).count() == 0


def test_the_run_is_its_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"again-{name}")
    columns = ["doc_id", "n_tokens", F.sha2(F.array_join("token_ids", ","), 256).alias("ids")]
    want = sorted(map(tuple, docs.select(*columns).collect()))
    got = corpus_pipeline.run(spark, SF_DIR).select(*columns).collect()
    assert sorted(map(tuple, got)) == want and want
