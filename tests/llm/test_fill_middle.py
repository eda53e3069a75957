"""Fill-in-middle against a plain version on Python strings, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordertide.llm import fill_middle as M
from ordertide.llm.common import read_table
from ordertide.llm.queries import QUERIES
from tests.comparing import TESTDATA

CASES = ["", None, "one", "one\n", "\n", "\n\n\n", "a\nb", "é\n日本\n😀x", "a<P>b\nc", "<S>", "x <M>\n",
         "<P\n>", "a\r\nb c\n", "<", "P>\n<", "<S\n<P\n<M", "x" * 70_000 + "\n" + "日" * 70_000]


def plain(doc_id, text, unit, seed=7, rate=100, spm=50):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit, rate", [("line", 100), ("line", 40), ("char", 100)])
def test_equals_plain_version(spark, unit, rate):
    pick = random.Random(5)
    rows = [(i, "".join(pick.choice("ab\n\né日😀< >PSM") for _ in range(pick.randint(0, 60))))
            for i in range(300)] + list(enumerate(CASES, 1000)) + [(None, "a\nb\nc"), (1003, "one\n")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, n int")
    made = M.fill_in_middle(docs, unit=unit, rate=rate).withColumn("back", M.restored(F.col("output"), F.col("form")))
    got = made.collect()
    want = [(i, *plain(i, t, unit, rate=rate), t or "") for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_query_on_whole_table(spark):
    docs = read_table(spark, f"{TESTDATA}/sf0.001", "documents").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in docs:
        n, form, p, m, out = plain(r.doc_id, r.text, "line")
        want.append((r.doc_id, n, form, p, m, sha(out), sha(r.text or "")))
    got = QUERIES["op13_fill_in_middle"](spark, f"{TESTDATA}/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_index_both_ways():
    text = "aé日😀bc" * 50 + "plain"
    data = np.frombuffer(text.encode(), np.uint8)
    index = M.ByteIndex(data)
    at = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert index.points(at).tolist() == list(range(len(text) + 1))
    assert index.offsets(np.arange(len(text) + 1)).tolist() == at.tolist()
    assert len(M.ByteIndex(np.frombuffer(b"plain ascii", np.uint8)).begin) == 0


def test_empty_table_and_names(spark):
    docs = spark.createDataFrame([], "`a.b` string, `my text` string, plain int, spm int")
    made = M.fill_in_middle(docs, "a.b", "my text")
    assert made.columns == ["a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert M.digests(made, "a.b").collect() == []
    with pytest.raises(ValueError):
        M.fill_in_middle(docs, "a.b", "my text", unit="byte")
