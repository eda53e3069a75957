"""Cross parsing against a plain search for longest matches; held-out accuracy."""

import random

import numpy as np
from pyspark.sql import functions as F

from ordertide.llm import language_id as L
from ordertide.llm.common import read_table
from ordertide.llm.queries import QUERIES
from tests.comparing import TESTDATA

SCHEMA = "doc_id long, text string, lang string, score string"


def plain_phrases(text, sample):
    """Greedy longest matches, cut at multiples of SEGMENT symbols."""
    text, sample, count = L.normalized(text), L.normalized(sample)[:L.MODEL_CHARS], 0
    for start in range(0, len(text), L.SEGMENT):
        part, at = text[start:start + L.SEGMENT], 0
        while at < len(part):
            n = 1
            while at + n <= len(part) and part[at:at + n] in sample:
                n += 1
            at += max(1, n - 1)
            count += 1
    return count


def test_phrases_equal_plain_search(monkeypatch):
    monkeypatch.setattr(L, "SEGMENT", 40)
    pick = random.Random(1)
    make = lambda letters, n: "".join(pick.choice(letters) for _ in range(n))
    samples = {"a": make("abc  ", 300), "b": make("abd ", 200), "c": "é" + make("xyzé !", 100)}
    texts = [make("abcdxyzé 1!", pick.randint(0, 200)) for _ in range(60)] + ["", "123", "ÀB cd"]
    parser = L.Parser(samples)
    got = parser.phrases([parser.symbols(t) for t in texts])
    want = [[plain_phrases(t, samples[n]) for n in parser.languages] for t in texts]
    assert got.tolist() == want


def test_automaton_knows_exactly_the_substrings():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    moves = L.suffix_automaton(text)
    inside = {tuple(text[a:b]) for a in range(9) for b in range(a + 1, 10)}
    for size in range(1, 5):
        for code in np.ndindex(*(3,) * size):
            state = 0
            for s in code:
                state = moves[state].get(s + 1) if state is not None else None
            assert (state is not None) == (tuple(c + 1 for c in code) in inside)


def test_held_out_accuracy(spark):
    folder = f"{TESTDATA}/sf0.01"
    found = QUERIES["op10_language_id"](spark, folder)
    docs = read_table(spark, folder, "documents")
    both = found.join(docs.select("doc_id", "lang"), "doc_id")
    right, n = both.filter("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 250 and right > 0.98
    assert found.filter("score < 0 OR score > 1").isEmpty() and found.count() == docs.count()


def test_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en", "x") for i in range(9)] + [
        (10 + i, "le chat et le chien", "fr", "x") for i in range(9)] + [
        (30, None, "en", "x"), (31, "", None, "x"), (32, "12 !?", "en", "x"), (33, "dog", None, "x"),
        (33, "dog", None, "x"), (None, "chien", None, "x"), (34, "日本", None, "x"), (35, "le " * 40_000, None, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = L.identify(df, L.learn(df)).collect()
    names = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows) and names[33] == "en" and names[None] == names[35] == "fr"
    assert [names[k] for k in (30, 31, 32)] == ["und"] * 3 and names[34] in ("en", "fr")
    assert {r.score for r in got if r.lang_pred == "und"} == {0.0}
    assert sorted(r.doc_id or 0 for r in L.keep_known(df, L.learn(df)).collect()) == sorted(
        (r[0] or 0) for r in rows if r[0] not in (30, 31, 32))
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(bare, L.learn(bare)).collect()} == {"und"}
    assert L.identify(df.limit(0), L.learn(df)).collect() == []


def test_text_behind_a_foreign_header_teaches(spark):
    header = "this header is the same in every document and tells nothing about it. " * 35
    pick = random.Random(7)
    french, english = ["le chat", "la maison", "dans", "et le chien", "sont", "avec"], [
        "the cat", "the house", "in", "and the dog", "are", "with"]
    rows = [(i, header + " ".join(pick.choices(french, k=40)), "fr", "") for i in range(30)] + [
        (100 + i, header + " ".join(pick.choices(english, k=40)), "en", "") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    samples = L.learn(df)
    asked = spark.createDataFrame([(1, "le chat et le chien sont dans la maison"), (2, "the cat and the dog are in the house")],
                                  "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in L.identify(asked, samples).collect()}
    assert "chien" in samples["fr"] and got == {1: "fr", 2: "en"}


def test_samples_come_from_all_over_a_text(spark):
    text = " ".join(f"w{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(600)) * 10
    rows = spark.createDataFrame([(i, text) for i in range(40)], "i long, text string")
    parts = [r[0] for r in rows.select(L.sampled(F.col("text"), F.col("i"))).collect()]
    each, room = L.SAMPLE_CHARS // L.PIECES, len(text) // L.PIECES
    for part in parts:
        assert len(part) == L.SAMPLE_CHARS + L.PIECES - 1
        for k in range(L.PIECES):
            assert part[k * (each + 1):][:each] in text[k * room:(k + 1) * room]
    assert len(set(parts)) == 40


def test_copies_of_an_id_stay_out_of_the_driver(spark):
    copies = spark.range(30_000).select(
        F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("the cat "), F.col("id") % 7).alias("text"),
        F.lit("en").alias("lang"), F.lit("x").alias("score"))
    rest = spark.range(2, 300).select("id", F.lit("the dog"), F.lit("en"), F.lit("x"))
    rows = L.sample_rows(copies.union(rest))
    assert rows.count() <= L.SAMPLE_ROWS and L.sample_rows(copies).collect()[0].part == "the cat 0"
