"""Token counts against encoding each text whole."""

import random

import pytest

from ordertide.llm import token_counts
from ordertide.llm.queries import tokenizer

PATH = tokenizer("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    tok = token_counts._open(PATH)
    return lambda text: len(tok.encode(text or "", add_special_tokens=False).ids)


def texts():
    pick = random.Random(5)
    parts = ["we'll", " don't", "  ", "\n\n\t ", "1234", " éàß", "<|endoftext|>", "日本語", "'re", "'",
             " word", "!!", "\U0001f600", "   a", "<|endof"]
    mixed = ["".join(pick.choice(parts) for _ in range(pick.randint(50, 900))) for _ in range(30)]
    return mixed + ["", None, "a", "x" * 3000, " " * 2000, "ab " * 700, "'re" * 500,
                    "<|endoftext|>" * 200, ("q" * 700 + " ") * 4]


def counts(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = token_counts.count_tokens(df, PATH, **sizes)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("chunk, overlap", [(64, 20), (128, 64), (1 << 15, 512)])
def test_splices_equal_whole_texts(spark, whole, chunk, overlap):
    rows = [(i, t, -1) for i, t in enumerate(texts())]
    want = [(i, len((t or "").encode()), whole(t)) for i, t, _ in rows]
    assert counts(spark, rows, chunk=chunk, overlap=overlap) == sorted(want, key=str)


def test_repeated_rows_null_ids_and_empty_table(spark, whole):
    long = "some words here " * 40
    rows = [(1, long, 0), (1, long, 0), (None, long, 0), (2, long, 0), (None, None, 0)]
    n = whole(long)
    want = [(i, 640 if t else 0, n if t else 0) for i, t, _ in rows]
    assert counts(spark, rows, chunk=100, overlap=40) == sorted(want, key=str)
    assert counts(spark, [], chunk=100, overlap=40) == []


def test_boundaries_are_common_far_more_often_than_not(spark):
    """The first pass, not the fallback to whole texts, gives the counts of ordinary prose."""
    df = spark.createDataFrame([("k", "plain prose of many words " * 100)], "key string, text string")
    assert token_counts._spliced(df, PATH, 256, 64).filter("n_tokens IS NULL").isEmpty()
