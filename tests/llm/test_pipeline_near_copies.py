"""The near-duplicate stage of the pipeline: five-word shingles, 80 %."""

import random

import numpy as np

import corpus_pipeline
from ordertide.llm import ngram_join
from ordertide.llm.common import read_table
from tests.comparing import TESTDATA
from tests.llm.test_ngram_join import shingle_set


def kept(rows, n=5, percent=80):
    """Ids that stay: rows without words, and the smallest id of each component."""
    sets = [(i, shingle_set(t, n)) for i, t in sorted(rows)]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i for i, s in sets if not s or find(i) == i}


def test_copies_with_edits_and_added_text(spark):
    pick = random.Random(3)
    text = [f"w{pick.randint(0, 9999)}" for _ in range(1000)]
    edited, longer, other = list(text), text + [f"v{n}" for n in range(180)], list(text)
    for place in range(25, 1000, 50):
        edited[place] = "edit"
    for place in range(10, 1000, 20):
        other[place] = "edit"
    rows = [(n, " ".join(w)) for n, w in enumerate([text, edited, longer, other])] + [(9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.dedup_documents(spark, docs, "").collect()}
    assert got == kept(rows) == {0, 3, 9}


def test_stage_against_all_pairs(spark):
    docs = read_table(spark, f"{TESTDATA}/sf0.01", "documents").filter("doc_id < 500 or doc_id between 640 and 950")
    docs = docs.select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = [r.doc_id for r in corpus_pipeline.dedup_documents(spark, docs, "").collect()]
    want = kept(rows)
    assert sorted(set(got)) == sorted(want) and want != kept(rows, 3, 90)


def test_keys_meet_at_this_similarity():
    make = np.random.default_rng(8)
    met = 0
    for _ in range(300):
        a = np.unique(make.integers(0, 1 << 62, int(10 ** make.uniform(0, 3.3))).astype(np.uint64))
        drop, add = make.integers(0, len(a) // 8 + 1, 2)
        b = np.unique(np.concatenate([make.permutation(a)[drop:],
                                      make.integers(0, 1 << 62, add).astype(np.uint64)]))
        if ngram_join.linked(a, b, 80) and not np.array_equal(a, b):
            met += 1
            assert np.intersect1d(ngram_join.keys(a, 80), ngram_join.keys(b, 80)).size
    assert met > 100
