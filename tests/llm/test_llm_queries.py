"""The registered corpus queries and the pipeline, stage by stage against brute force."""

from __future__ import annotations

import hashlib
import re
import string
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "scripts"))

import check_queries  # noqa: E402
import corpus_pipeline  # noqa: E402
from gaugeworks.llm import chunk_dedup, decontaminate, quality_rules  # noqa: E402
from gaugeworks.llm.common import written  # noqa: E402
from gaugeworks.llm.queries import VOCABULARY, oracle_sql, queries  # noqa: E402

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def con():
    return check_queries.database(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF_DIR, name) is None


def test_one_query_per_operator_and_five_stages():
    assert [name.split("_")[0] for name in queries()] == [f"op{n}" for n in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5


def test_bpe_query_equals_the_library(spark):
    library = Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in queries()["op5_bpe_round_trip"](spark, SF_DIR).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_equals_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(written(stage(spark, steps[-1], SF_DIR), f"test-{name}"))
    for frame in steps[1:-1]:
        assert frame.columns == docs.columns
    texts = [{r.doc_id: r.text for r in frame.collect()} for frame in steps[:-1]]

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    statistics = written(quality_rules.with_statistics(docs).drop("text"), "test-statistics")
    rules = quality_rules.learn_rules(statistics, labels)
    want = {r.doc_id for r in statistics.filter(quality_rules.kept(rules)).collect()}
    assert set(texts[1]) == want and len(want) < len(texts[0])
    clean = labels.filter("quality = 1").select("doc_id").collect()
    base = {r.doc_id for r in statistics.filter(~quality_rules.base_failed()).collect()}
    assert {r.doc_id for r in clean} & base <= want

    sets = {k: shingles(t) for k, t in texts[1].items()}
    least = {k: k for k in sets}
    for _ in range(20):
        for a in sets:
            for b in sets:
                if least[b] < least[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b]
    assert set(texts[2]) == {k for k in sets if least[k] == k or not sets[k]}

    first: dict[int, int] = {}
    chunked = {}
    for key in sorted(texts[2]):
        ends, digests = chunk_dedup.chunk_block([texts[2][key].encode()])
        chunked[key] = ends[0], digests[0]
        for link in chunk_dedup.link_digests(ends[0], digests[0], chunk_dedup.MIN_RUN)[0].tolist():
            first.setdefault(link, key)
    for key, (ends, digests) in chunked.items():
        links = chunk_dedup.link_digests(ends, digests, chunk_dedup.MIN_RUN)[0].tolist()
        known = {link for link in links if first[link] < key}
        spans, *_ = chunk_dedup.cut_repeats(ends, digests, known, chunk_dedup.MIN_RUN)
        data = texts[2][key].encode()
        for begin, end in reversed(spans):
            data = data[:begin] + data[end:]
        assert texts[3].get(key) == (data.decode() if data.strip() or not spans else None)
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())

    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    windows = defaultdict(set)
    for item in map(decontaminate.words_of, items):
        size = min(10, len(item))
        windows[size] |= {tuple(item[k : k + size]) for k in range(len(item) - size + 1)}
    want = set()
    for key, text in texts[3].items():
        words = decontaminate.words_of(text)
        if not any(
            tuple(words[k : k + size]) in some
            for size, some in windows.items()
            for k in range(len(words) - size + 1)
        ):
            want.add(key)
    assert set(texts[4]) == want

    library = Tokenizer.from_file(VOCABULARY)
    last = {r.doc_id: r for r in steps[5].collect()}
    assert set(last) == want and all(r.round_trip for r in last.values())
    for key, row in last.items():
        assert row.token_ids == library.encode(texts[4][key], add_special_tokens=False).ids
    assert steps[5].filter(F.size("token_ids") != F.col("n_tokens")).count() == 0


def test_one_row_of_a_group_stays_with_null_ids_and_repeated_rows(spark):
    base = [" ".join(f"{name}{k}" for k in range(60)) for name in "abcde"]
    near = [text.replace("30 ", "30x ") for text in base]
    rows = [
        *[(1, base[0], "en"), (None, base[0], "en"), (None, near[0], "en"), (9, near[0], "en")],
        *[(None, base[1], "en"), (None, base[1], "de"), (None, near[1], "en"), (None, base[1], "en")],
        *[(3, base[2], "en")] * 3,
        *[(4, base[3], "en"), (4, near[3], "en"), (4, base[4], "en"), (5, base[4], "en")],
        *[(6, None, "en"), (None, None, "en"), (7, " ", "en")],
    ]
    docs = spark.createDataFrame(
        [(k, t, lang, "s", len(t or "")) for k, t, lang in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = corpus_pipeline.near_duplicates(spark, docs.repartition(4), SF_DIR)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "-")[0]) for r in kept.collect()), key=str)
    want = [(1, "a"), (None, "b"), (3, "c"), (4, "d"), (4, "e"), (6, "-"), (None, "-"), (7, " ")]
    assert got == sorted(want, key=str)
