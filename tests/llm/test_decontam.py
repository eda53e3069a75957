"""Decontamination against edit distances by dynamic programming."""

import random

import pytest

from ordertide.llm import decontam
from ordertide.llm.common import read_table
from tests.comparing import TESTDATA


def nearest(item, text):
    """Least word edits between ``item`` and any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for k, word in enumerate(item, 1):
        new = [k]
        for n, other in enumerate(text, 1):
            new.append(min(row[n] + 1, new[n - 1] + 1, row[n - 1] + (word != other)))
        row = new
    return min(row)


def corpus(seed, items=12, docs=120, edits=0.2):
    """Items, texts, and the edits of the copy that a text holds (or None)."""
    pick = random.Random(seed)
    words = [f"w{n}" for n in range(300)] + ["the", "of", "and"] * 60
    make = lambda n: [pick.choice(words) for _ in range(n)]
    bench = [make(pick.randint(8, 50)) for _ in range(items)]
    rows = []
    for d in range(docs):
        text, k = make(pick.randint(0, 120)), pick.randrange(items)
        if d % 2:
            copy = list(bench[k])
            for _ in range(pick.randint(0, int(edits * len(copy)))):
                place = pick.randrange(len(copy))
                copy[place:place + 1] = pick.choice([[], ["xyz"], [copy[place], "xyz"]])
            at = pick.randint(0, len(text))
            text[at:at] = copy
        rows.append((d, text))
    return bench, rows


def found(spark, rows, bench, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    return decontam.find_items(docs, items, **more).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_verified_exactly_and_recall(spark, seed):
    bench, rows = corpus(seed)
    got = found(spark, [(d, ", ".join(w).upper(), "") for d, w in rows],
                [(k, " ".join(w)) for k, w in enumerate(bench)])
    want = {(d, k): n for d, text in rows for k, item in enumerate(bench)
            if (n := nearest(item, text)) <= int(0.2 * len(item))}
    edits = {(r.doc_id, r.item_id): r.edits for r in got}
    assert set(edits) <= set(want)
    assert all(edits[p] == want[p] for p in edits)
    assert len(edits) >= 0.97 * len(want) and len(want) > 40


def test_bit_parallel_distance():
    pick = random.Random(9)
    for _ in range(300):
        item = [pick.randint(1, 4) for _ in range(pick.randint(1, 70))]
        text = [pick.randint(1, 4) for _ in range(pick.randint(0, 90))]
        got = decontam.best_stretch(item, text, len(item))
        assert (got[0] if got else len(item)) == nearest(item, text)
        if got:
            assert nearest(item, text[got[1]:got[2]]) == got[0]


def test_spans_edge_cases_and_filter(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, f"Intro, {item.upper()}! End.", "x"), (1, f"Intro, {item.upper()}! End.", "x"),
            (2, None, "x"), (3, "", "x"), (4, "alpha beta gamma", "x"), (None, item, "x"),
            (5, "word " * 30_000 + item, "x")]
    bench = [(7, item), (8, item), (9, "too short"), (10, None), (None, item)]
    got = sorted(((r.doc_id, r.item_id, r.edits, r.n_words, r.start, r.end)
                  for r in found(spark, rows, bench)), key=str)
    want = [(d, k, 0, 10, s, s + len(item)) for d, s in ((1, 7), (1, 7), (None, 0), (5, 150_000))
            for k in (7, 8)]
    assert got == sorted(want, key=str)
    assert found(spark, [], bench) == [] and found(spark, rows, []) == []
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    kept = decontam.drop_contaminated(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_query_finds_every_exact_passage(spark):
    from ordertide.llm.queries import QUERIES

    folder = f"{TESTDATA}/sf0.001"
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, folder).collect()}
    items = read_table(spark, folder, "benchmark").collect()
    exact = {(d.doc_id, i.item_id) for d in read_table(spark, folder, "documents").collect()
             for i in items if i.text in d.text}
    assert exact and exact <= got
