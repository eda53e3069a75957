"""Sampled segmentations: exact distribution, reproducible, lossless."""

import math
from collections import Counter

import pytest

from ordertide.llm import common, language_id, sentence_pieces as S
from ordertide.llm.common import read_table
from ordertide.llm.queries import tokenizer
from tests.comparing import TESTDATA

PATH = tokenizer("piece_bpe_32k.model")
SCHEMA = "doc_id string, text string, ids string, n_pieces int"
TEXTS = ["hello world", "  a  b\n\tc ", "\u0000x", "①ﬁ é é", " ", "", None, "▁x ▁", "日本語テキスト", "x" * 5000,
         "a" + " " * 40 + "b", "\U0001f600\U0001f600 ok", "ABC\r\nDEF", "word " * 30_000, "  é"]


@pytest.fixture(scope="module")
def vocabulary():
    return S.vocabulary_of(PATH, S.THETA)


def test_round_trip(spark):
    rows = [(str(i), t, "x", 0) for i, t in enumerate(TEXTS)] + [(None, "same key", "x", 0)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    out = S.encode_texts(df, PATH)
    got = out.collect()
    assert len(got) == len(rows) and all(r.lossless and r.n_pieces == len(r.ids) for r in got)
    back = S.decode_texts(out, PATH).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t, _, _ in rows)
    again = S.encode_texts(df.repartition(7), PATH).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in again) == Counter((r.doc_id, tuple(r.ids)) for r in got)
    assert S.encode_texts(df.limit(0), PATH).collect() == []


def paths(vocabulary, text):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in vocabulary.pieces:
            for rest in paths(vocabulary, text[n:]):
                yield [text[:n], *rest]


@pytest.mark.parametrize("word", ["thing", "aba", "xy"])
def test_distribution(vocabulary, word):
    weights = {tuple(vocabulary.pieces[p][0] for p in path): math.exp(
        sum(vocabulary.pieces[p][1] for p in path)) for path in paths(vocabulary, S.MARK + word)}
    total, count = sum(weights.values()), 30_000
    ids, offsets = S.encode(S.Lattices(vocabulary), list(range(count)), [word] * count)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:]))
    assert set(seen) <= set(weights) and len(weights) > 2
    assert all(abs(seen[k] / count - w / total) < 0.015 for k, w in weights.items())


def test_words_of_a_row_are_sampled_independently(vocabulary):
    ids, offsets = S.encode(S.Lattices(vocabulary), [1], ["thing " * 400])
    pieces = [vocabulary.model.id_to_piece(int(i)) for i in ids]
    words = " ".join(pieces).replace(" " + S.MARK, "\n" + S.MARK).split("\n")
    assert len(set(words)) > 3


def test_bounded_store_gives_the_same(vocabulary):
    texts = [f"some words number {n} {'q' * (n % 40)}" for n in range(300)]
    keys = list(range(300))
    small = S.Lattices(vocabulary, bound=50)
    whole = S.encode(S.Lattices(vocabulary), keys, texts)[0].tolist()
    parts = [S.encode(small, keys[k:k + 10], texts[k:k + 10])[0].tolist() for k in range(0, 300, 10)]
    assert sum(parts, []) == whole


def test_a_store_takes_little_more_than_its_entries():
    grown, values = S.Growing(int), list(range(200_000))
    for k in range(0, len(values), 5_000):
        grown.add(values[k:k + 5_000])
        assert len(grown.data) <= max(1 << 16, 1.5 * grown.size)
    assert grown.data[:grown.size].tolist() == values


def test_a_worker_keeps_one_model_at_a_time(vocabulary):
    language_id._parser((("en", "some words"),))
    assert len(common._kept) == 1 and vocabulary not in common._kept.values()
    again = S.vocabulary_of(PATH, S.THETA)
    assert list(common._kept.values()) == [again] and S.vocabulary_of(PATH, S.THETA) is again


def test_high_theta_gets_near_the_usual_segmentation(vocabulary):
    sharp = S.Vocabulary(PATH, 30.0)
    text = "the quick brown fox jumps over the lazy dog"
    ids, _ = S.encode(S.Lattices(sharp), [0], [text])
    assert len(ids) <= len(sharp.model.encode(text)) + 3


def test_documents(spark):
    docs = read_table(spark, f"{TESTDATA}/sf0.001", "documents")
    assert S.encode_texts(docs, PATH).filter("NOT lossless").isEmpty()


def test_python_is_handed_few_texts_at_a_time(spark):
    """A batch is held by the executor and by the worker; 10,000 whole texts took too much of both."""
    rows = spark.range(3000).coalesce(1)
    found = common.map_rows(
        rows, lambda: lambda b: [b.column(0), [b.num_rows] * b.num_rows], "id long, held long", size=100_000)
    sizes = found.groupBy("held").count().collect()
    assert sum(r["count"] for r in sizes) == 3000 and max(r["held"] for r in sizes) <= common.BATCH
