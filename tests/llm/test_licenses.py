"""Licence scans against plain searches; planted passages, edited and whole."""

import random
import re

from ordertide.llm import licenses as L
from ordertide.llm.common import read_table
from ordertide.llm.license_texts import PASSAGES, PHRASES
from ordertide.llm.queries import QUERIES
from tests.comparing import TESTDATA

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCANNER = L.Scanner(PASSAGES, PHRASES)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_base(text):
    words = plain_words(text)
    return [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items()
            if words[i:i + len(phrase.split())] == phrase.split()]


def plain_row(doc_id, text):
    base = plain_base(text)
    return (doc_id, len(plain_words(text)), len(base), base[0][0] if base else None, base[-1][0] if base else None,
            ",".join(sorted({label for _, label in base})))


def test_base_equals_plain_search_on_whole_table(spark):
    folder = f"{TESTDATA}/sf0.01"
    want = [plain_row(r.doc_id, r.text) for r in read_table(spark, folder, "documents").collect()]
    rows = QUERIES["op11_license_scans"](spark, folder).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == sorted(want)
    assert sum(r.n_base for r in rows) > 10
    for r in rows:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
        assert 0 <= r.score <= 1 and (r.score == 1 if r.n_base else True)


def test_matching_statistics_equal_plain_search():
    sequences = [s.split() for s in ("a b a c", "b a b b c", "c a b a", "a b a c", "d", "a")]
    automaton = L.Automaton([[w.encode() for w in s] for s in sequences])
    scanner = L.Scanner({"x": [" ".join(s) for s in sequences]}, {"b a b": "p", "a b": "q", "b": "r"})
    pick = random.Random(1)
    for _ in range(300):
        words = [pick.choice("aaabbbcde") for _ in range(pick.randint(0, 25))]
        got = {end: length for end, _, length in scanner.matches([w.encode() for w in words]) if length}
        for end in range(1, len(words) + 1):
            runs = [n for n in range(1, end + 1) if any(
                words[end - n:end] == s[k:k + n] for s in sequences + [["b", "a", "b"]] for k in range(len(s)))]
            assert got.get(end, 0) == max(runs, default=0)
        base, _ = scanner.scan([w.encode() for w in words])
        assert base == sorted((i, k) for k, p in enumerate(("bab", "ab", "b"))
                              for i in range(len(words)) if words[i:i + len(p)] == list(p))
    for places, size in zip(automaton.places[1:], automaton.size[1:]):
        runs = {tuple(sequences[t][end - size:end]) for t, end in places}
        assert len(runs) == 1
        run = list(runs.pop())
        assert sorted(places) == sorted((t, k + size) for t, s in enumerate(sequences)
                                        for k in range(len(s)) if s[k:k + size] == run)


def filler(pick, n):
    return " ".join(pick.choice(["the", "software", "of", "license", "any", "copy", "tree", "river"]) for _ in range(n))


def test_whole_passages_are_found():
    pick = random.Random(2)
    for label, texts in PASSAGES.items():
        for text in texts:
            words = len(plain_words(text))
            before = filler(pick, 30)
            n, _, spans, score = SCANNER.report(f"{before}\n// {text.upper()}\n{filler(pick, 30)}")
            hit = [s for s in spans if s[0] == label and s[4] == 1.0]
            assert score == 1.0 and n == 60 + words
            assert any(abs(start - 30) <= L.GAP and covered == words for _, start, _, covered, _ in hit), (label, spans)


def test_edited_passages_are_found():
    pick = random.Random(3)
    for label, texts in PASSAGES.items():
        for text in texts:
            words = plain_words(text)
            if len(words) < 25:
                continue
            edited = [w for i, w in enumerate(words) if i % 30 != 29]  # dropped
            edited = ["edit" if i % 23 == 11 else w for i, w in enumerate(edited)]
            _, _, spans, score = SCANNER.report(" ".join([filler(pick, 20), *edited, filler(pick, 20)]))
            assert score >= 0.7 and any(s[0] == label and s[4] >= 0.7 for s in spans), (label, score)


def test_no_label_without_a_passage():
    pick = random.Random(4)
    for _ in range(20):
        _, base, spans, score = SCANNER.report(filler(pick, 2000))
        assert not base and not spans and score < L.COVER
    half = " ".join(plain_words(PASSAGES["ISC"][0])[:10])
    assert SCANNER.report(half)[2] == [] and 0 < SCANNER.report(half)[3] < L.COVER


def test_two_copies_are_two_spans():
    text = PASSAGES["Unlicense"][0]
    spans = SCANNER.report(text + " tree " * 20 + text)[2]
    n = len(plain_words(text))
    assert [(s[1], s[2], s[4]) for s in spans] == [(0, n, 1.0), (n + 20, 2 * n + 20, 1.0)]


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (3, "- _ !"), (4, "MIT licenses mit-LICENSE"), (5, "cc by cc by"),
            (6, "apache license"), (7, "gnu " * 50_000 + "general public license"), (8, "İmit license")]
    docs = spark.createDataFrame([(i, t, "x", 0, 1.0) for i, t in rows],
                                 "doc_id long, text string, base string, n_words int, score double")
    got = L.summary(L.scan_licenses(docs))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows_out = sorted((tuple(r)[:6] for r in got.collect()), key=str)
    assert rows_out == sorted((plain_row(i, t) for i, t in rows), key=str)
    assert L.summary(L.scan_licenses(docs.limit(0))).collect() == []
    own = L.scan_licenses(docs, passages={"own": ["mit licenses mit"]}, phrases={}).filter("doc_id = 4").first()
    assert own.base == [] and own.spans == [] and own.score == 0.0  # shorter than an anchor
