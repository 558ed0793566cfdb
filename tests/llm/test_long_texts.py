"""Texts of several MB, short repeated passages, and counters at their largest."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import decontaminate, jaccard, lempel_ziv, packing, suffix_dedup, tokens

SF = "/root/testdata/sf0.001"
CLASH = ", row string, key string, w long, fp long, tree string, stretches string"


def long_texts():
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9)))
    noise = " ".join(word() for _ in range(150_000))
    return {"blanks": " " * 2_000_000, "between": "a" + " " * 1_500_000 + "b", "letter": "x" * 2_000_000, "lines": "\n" * 1_200_000 + "end", "word": "go " * 500_000, "noise": noise, "copy": noise, "unicode": "é𝄞" * 400_000}


@pytest.fixture(scope="module")
def giants(spark):
    rows = [(n, t, "en", "s", len(t), *[None] * 6) for n, t in enumerate(long_texts().values())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + CLASH).repartition(3).cache()


def test_ids_of_long_texts():
    draw = random.Random(1)
    some = ["".join(draw.choice("ab \n\té𝄞<|endoftext|>0") for _ in range(n)) for n in (0, 1, 50, tokens.LONG - 1, tokens.LONG, tokens.LONG + 1)]
    for text in [*some, *(t[: tokens.LONG] for t in long_texts().values())]:
        assert tokens.encode(text).tolist() == tokens.tokenizer().encode(text, add_special_tokens=False).ids


def test_operators_bear_long_texts(giants):
    texts = list(long_texts().values())
    bytes_ = [len(t.encode()) for t in texts]
    got = {r["row"]["doc_id"]: r for r in suffix_dedup.cut_repeats(giants).select("row", "n_bytes", "n_removed").collect()}
    assert [got[n]["n_bytes"] for n in range(len(texts))] == bytes_
    # all but what holds no 400-byte string twice; the noise has a copy
    assert [got[n]["n_removed"] for n in range(len(texts))] == [bytes_[0], bytes_[1] - 2, bytes_[2], bytes_[3] - 3, bytes_[4], *bytes_[5:7], bytes_[7]]
    words = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in lempel_ziv.cut_repeats(giants, with_text=False).collect()}
    assert words == {0: (0, 0), 1: (2, 0), 2: (1, 0), 3: (1, 0), 4: (500_000, 499_999), 5: (150_000, 0), 6: (150_000, 150_000), 7: (1, 0)}
    parts = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(giants).collect()}
    assert parts[0] == (0, 0) and parts[4] == (1, 4) and parts[5][1] == parts[6][1] == 5 and parts[1] == (1, 1)


def test_packing_of_long_texts(giants):
    made = packing.pack(packing.pieces(giants)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = [len(tokens.encode(t)) + 1 for t in long_texts().values()]
    assert {r["doc_id"]: r["n"] for r in made} == dict(enumerate(want))


def test_stages_bear_long_texts_and_clashing_names(spark, giants):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, giants, SF)
        n = got.count()
        if name == "benchmark_decontamination":
            assert n == giants.count() and got.columns == giants.columns
        if name == "ngram_jaccard_join":
            # the copy of the noise goes
            assert n == giants.count() - 1


def test_items_in_long_texts(spark, giants):
    items = spark.createDataFrame([(1, "go go go go go go go go go go"), (2, "end"), (3, "nowhere to be found")], "item_id long, text string")
    found = decontaminate.find_items(giants, items).where(F.size("spans") > 0).select("row.doc_id").collect()
    assert sorted(r["doc_id"] for r in found) == [3, 4]


@pytest.mark.parametrize("n", [51, 65])
def test_stage_cuts_passages_of_over_fifty_words(spark, n):
    draw = random.Random(n)
    word = lambda: "".join(draw.choice("abcdefghijkl") for _ in range(draw.randint(2, 7)))
    passage = " ".join(word() for _ in range(n))
    rows = [(d, " ".join(word() for _ in range(80)) + " " + passage + " " + " ".join(word() for _ in range(80)), "en", "s", 1) for d in range(30)]
    rows += [(d, " ".join(word() for _ in range(200)), "en", "s", 1) for d in range(30, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, SF).collect()}
    assert all(passage not in got[d] for d in range(30))
    assert all(got[d] == t for d, t, *_ in rows[30:])


def test_largest_counters(spark):
    """As many counters as there can be, on few texts: sparse blocks, in several steps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", F.col("doc_id").alias("key")).repartition(6)
    made = jaccard.count_grams(docs.select("text", F.col("key").cast("string").cast("binary").alias("key")), 5, jaccard.COUNTERS[1])
    total = jaccard.merge_counts(made, jaccard.COUNTERS[1])
    want = np.zeros(jaccard.COUNTERS[1], np.int64)
    import pyarrow as pa

    from sessionloom.llm.common import texts

    for t in texts(pa.array([r["text"] for r in docs.select("text").collect()])):
        h, _ = jaccard.grams(t, 5)
        np.add.at(want, (h & np.uint64(jaccard.COUNTERS[1] - 1)).astype(np.int64), 1)
    assert (total == jaccard.packed(want)).all()
