"""Jaccard components against a brute force over all pairs."""

import random

import numpy as np
import pytest

from ordertide.llm import ngram_join
from ordertide.llm.common import read_table
from tests.comparing import TESTDATA


def shingle_set(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1)))


def brute(rows, percent=90):
    """(id, set size, component) of each row, by comparing all pairs of distinct sets."""
    sets = sorted({shingle_set(t) for _, t in rows}, key=len)
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for k, a in enumerate(sets):
        for b in sets[k + 1:]:
            if percent * len(b) > 100 * len(a):
                break
            if a and 100 * len(a & b) >= percent * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for i, t in rows:
        s = shingle_set(t)
        if s and i is not None:
            key = find(s)
            least[key] = min(i, least.get(key, i))
    return sorted(((i, len(shingle_set(t)), least.get(find(shingle_set(t))) if shingle_set(t) else i)
                   for i, t in rows), key=str)


def result(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = ngram_join.jaccard_components(df, **more)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str)


def corpus(seed, groups=25):
    pick = random.Random(seed)
    word = lambda: pick.choice(["the", "of", "a"] + [f"w{pick.randint(0, 5000)}"] * 4)
    rows = []
    for g in range(groups):
        base = [word() for _ in range(int(10 ** pick.uniform(0.3, 2.9)))]
        for _ in range(pick.randint(1, 6)):
            text = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 40))):
                text[pick.randrange(len(text))] = word()
            if pick.random() < 0.3:
                text = text[:pick.randint(1, len(text))] + [word() for _ in range(pick.randint(0, 9))]
            rows.append(" ".join(text))
    pick.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_corpus(spark, seed):
    rows = corpus(seed)
    assert result(spark, rows) == brute(rows)


def near_copies(count, size=150, seed=4):
    """Texts that differ in a word or two from one another, and some that share half."""
    pick = random.Random(seed)
    base = [f"b{n}" for n in range(size)]
    rows = []
    for i in range(count):
        text = list(base)
        for _ in range(pick.randint(0, 2)):
            text[pick.randrange(size)] = f"x{pick.randint(0, 999)}"
        if i % 7 == 0:
            text[size // 2:] = [f"own{i} {k}" for k in range(size // 4)]
        rows.append((1000 - i, " ".join(text)))
    return rows


@pytest.mark.parametrize("deals", [0, 1, 3])
def test_group_larger_than_a_block(spark, monkeypatch, deals):
    """Dealt over blocks, merged, dealt again, and at last met in pairs of blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 5000)
    monkeypatch.setattr(ngram_join, "DEALS", deals)
    rows = near_copies(120)
    assert result(spark, rows) == brute(rows)


def test_edge_cases(spark):
    text = "One two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (9, None), (8, ""), (8, " \t\n"),
            (7, "ab cd"), (6, "AB\x0bcd"), (4, "ab"), (None, "only here is this"), (1, "É é"), (2, "é é"),
            (20, "word " * 50_000), (21, "word " * 3)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_keys_meet_whenever_sets_link():
    make = np.random.default_rng(5)
    for _ in range(400):
        size = int(10 ** make.uniform(0, 3.3))
        a = np.unique(make.integers(0, 1 << 62, size).astype(np.uint64))
        drop = make.integers(0, size // 10 + 1)
        kept = make.permutation(a)[drop:]
        b = np.unique(np.concatenate([kept, make.integers(0, 1 << 62, make.integers(
            0, size // 10 + 1)).astype(np.uint64)]))
        if ngram_join.linked(a, b, 90) and not np.array_equal(a, b):
            for family in (0, 1, 2):
                assert np.intersect1d(ngram_join.keys(a, 90, family), ngram_join.keys(b, 90, family)).size


def test_keys_meet_at_the_very_edge():
    """Sets that differ in as many shingles as linked sets can, of all small sizes and some large ones."""
    make = np.random.default_rng(11)
    for percent in (60, 80, 90):
        for size in [*range(2, 40), *make.integers(40, 2000, 20).tolist()]:
            a = np.unique(make.integers(0, 1 << 62, size).astype(np.uint64))
            for share in (0.0, 0.3, 0.5, 1.0):
                for drop in range(len(a), -1, -max(1, len(a) // 100)):
                    gone, new = int(drop * share), drop - int(drop * share)
                    fresh = make.integers(0, 1 << 62, new).astype(np.uint64)
                    b = np.unique(np.concatenate([make.permutation(a)[gone:], fresh]))
                    if len(b) and drop and ngram_join.linked(a, b, percent):
                        assert np.intersect1d(ngram_join.keys(a, percent), ngram_join.keys(b, percent)).size
                        break


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c d", "x", 7, 1.0, 2, "r", 3), (2, "a b c d", "y", 8, 2.0, 3, "s", 4), (3, None, "z", 9, 3.0, 4, "t", 5)]
    schema = "doc_id long, text string, __id string, __hash int, `a.b c` double, id int, row string, c0 int"
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "__id", "__hash", "a.b c", "id", "row", "c0"]
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def test_tree_finds_all_pairs_that_the_bound_allows():
    make = np.random.default_rng(6)
    points = make.poisson(4, (300, ngram_join.GROUPS))
    points[100:200] = points[:100] + make.integers(0, 2, (100, ngram_join.GROUPS)) * make.integers(
        0, 2, (100, 1))
    tree = ngram_join.CountTree(points)
    sizes = points.sum(axis=1)
    for p in points[:150]:
        bound = np.minimum(points, p).sum(axis=1)
        want = (190 * bound >= 90 * (sizes + p.sum())) & (100 * sizes >= 90 * p.sum()) & (
            100 * p.sum() >= 90 * sizes)
        assert sorted(tree.search(p, 90)) == np.flatnonzero(want).tolist()


def test_query_on_the_tables(spark):
    from ordertide.llm.queries import QUERIES

    folder = f"{TESTDATA}/sf0.01"
    rows = [tuple(r) for r in read_table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op5_jaccard_components"](spark, folder).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
