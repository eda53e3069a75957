"""Line runs against a brute force over all windows."""

import random

from ordertide.llm import line_dedup
from ordertide.llm.common import read_table
from tests.comparing import TESTDATA


def brute(rows, min_words):
    """{(id, text): set of deleted line numbers}; rows are (id, text)."""
    order = sorted({r for r in rows if r[1] is not None},
                   key=lambda r: (r[0] is not None, r[0], digest(*r)))
    first, gone = {}, {}
    for place, (i, text) in enumerate(order):
        lines = text.split("\n")
        words = [len(x.encode().split()) for x in lines]
        for a in range(len(lines)):
            total, b = 0, a
            while b < len(lines) and total < min_words:
                total += words[b]
                b += 1
            if total < min_words:
                break
            run = tuple(lines[a:b])
            if run in first:
                gone.setdefault((i, text), set()).update(range(a, b))
            else:
                first[run] = (place, a)
    return gone


def digest(i, text):
    import hashlib

    key = ("true|" if i is None else f"false|{i}|") + text
    return hashlib.md5(key.encode()).digest()


def expect(rows, min_words):
    gone = brute(rows, min_words)
    out = []
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        cut = gone.get((i, text), set())
        kept = text if not cut else "\n".join(x for n, x in enumerate(lines) if n not in cut)
        out.append((i, len(lines), len(cut), kept))
    return sorted(out, key=str)


def result(spark, rows, min_words):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.dedup_lines(df, min_words=min_words)
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()), key=str)


def test_random_runs_equal_brute_force(spark):
    pick = random.Random(3)
    lines = ["a b c", "d e", "f", "", "g h i j", "k l", "  m\tn ", "o"]
    rows = [(i, "\n".join(pick.choice(lines) for _ in range(pick.randint(0, 14))))
            for i in range(60)]
    block = "\n".join(pick.choice(lines) + f" {n}" for n in range(40))
    rows += [(100 + i, f"own {i}\n{block}\nend {i}") for i in range(5)]
    rows += [(200, "x y\n" * 30), (201, None), (202, ""), (None, block), (None, None)]
    for least in (1, 4, 9, 60):
        assert result(spark, rows, least) == expect(rows, least), least


def test_repeated_rows_count_once_and_empty_table(spark):
    text = "one two three\nfour five six"
    assert result(spark, [(1, text), (1, text)], 4) == expect([(1, text), (1, text)], 4)
    assert result(spark, [(1, text), (2, text)], 4) == [(1, 2, 0, text), (2, 2, 2, "")]
    assert result(spark, [], 4) == []


def test_clean_document_is_untouched_and_copy_goes(spark):
    passage = " ".join(f"w{n}" for n in range(30)) + "\n" + " ".join(f"v{n}" for n in range(30))
    rows = [(1, "intro\n" + passage), (2, "other start\n" + passage + "\nother end"), (3, "clean")]
    got = {r[0]: r for r in result(spark, rows, 50)}
    assert got[1][3] == rows[0][1] and got[3][3] == "clean"
    assert got[2] == (2, 4, 2, "other start\nother end")


def test_suffix_array_order(spark):
    """Ranks order suffixes as their line ids do, and equal prefixes share a rank."""
    lines = [(b"d", 1, 0, i, x, 1) for i, x in enumerate([b"b", b"a", b"b", b"a", b"c"])]
    starts = spark.createDataFrame(
        lines, "doc binary, id long, stretch long, i long, line binary, need long")
    rows = line_dedup.suffix_ranks(starts, 2).orderBy("r2").collect()
    assert [r.i for r in rows] == [1, 3, 0, 2, 4]
    assert {r.i: r.r1 for r in rows} == {1: 0, 3: 1, 0: 2, 2: 2, 4: 4}


def test_query_on_the_tables(spark):
    folder = f"{TESTDATA}/sf0.001"
    from ordertide.llm.queries import QUERIES

    docs = [tuple(r) for r in read_table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op6_line_dedup"](spark, folder).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got), key=str) == expect(docs, 50)
