"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ordertide.llm import collocations as C
from ordertide.llm.common import read_table
from ordertide.llm.queries import QUERIES
from tests.comparing import TESTDATA

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest=5, least=100, top=2000, covered=100):
    """rows: (lang, text)."""
    counts, total = {}, Counter()
    for lang, text in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            f.update(tuple(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = total[lang], []
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        most = Counter()
        for p in candidates:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    part = p[i:i + size]
                    most[part] = max(most[part], f[p])
        for p in candidates:
            if p in most and 100 * most[p] >= covered * f[p]:
                continue
            score, _, l, r = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def text_of(pick, size):
    words = ["the", "of", "a", "Cat", "dog", "é日", "x\x00y", "\x85", "z" * 30]
    weights = [9, 7, 5, 3, 3, 2, 1, 1, 1]
    ends = [" "] * 12 + ["\t", "  ", ". ", "\n", "; ", "!? ", "\r\n"]
    return "".join(w + pick.choice(ends) for w in pick.choices(words, weights, k=size))


@pytest.mark.parametrize("longest, least, top, covered", [(5, 5, 2000, 100), (5, 3, 20, 60), (3, 2, 50, 100), (2, 2, 9, 100)])
def test_equals_plain_count(spark, monkeypatch, longest, least, top, covered):
    monkeypatch.setattr(C, "TRIGGER", 6)
    pick = random.Random(longest * least)
    rows = [(pick.choice(["en", "fr", None]), text_of(pick, pick.randint(0, 80))) for _ in range(60)]
    rows += [("en", rows[0][1])] * 5 + [("de", None), ("de", ""), ("es", " .\n"), ("und", "one two one two"),
                                        ("long", "again " * 3000), ("long", "a b. " * 500)]
    docs = spark.createDataFrame([(l, t, "p", 1, "c") for l, t in rows],
                                 "lang string, text string, phrase string, n int, chunk string")
    got = sorted(map(tuple, C.collocations(docs, longest=longest, least=least, top=top, covered=covered).collect()))
    assert got == plain(rows, longest, least, top, covered) and got


def plain_tokens(text):
    out = []
    for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER).encode()):
        words = re.findall(rb"[^\x20\x09]+", piece)
        out += words + [b"\n"] * bool(words)
    return out


@pytest.mark.parametrize("trigger", [1, 2, 5, 1000])
@pytest.mark.parametrize("part", [40, 1 << 20])
def test_every_place_in_one_chunk(monkeypatch, trigger, part):
    pick = random.Random(2)
    monkeypatch.setattr(C, "TRIGGER", trigger)
    monkeypatch.setattr(C, "PART", part)
    texts = [text_of(pick, size) for size in (0, 1, 2, 3, 0, 4, 5, 9, 200)] + [None, " . ", "x", "x y", "\n\nz."]
    parts = [(t, data) for t, text in enumerate(texts) for data in C.parts_of(text)]
    found, of = C.chunks([data for _, data in parts], 4)
    for t, text in enumerate(texts):
        own = [c.split(b" ") for c, p in zip(found, of) if parts[p][0] == t]
        assert [w for c in own for w in c[:-4]] == plain_tokens(text)
    for p in range(len(parts)):
        own = [c.split(b" ") for c, q in zip(found, of) if q == p]
        # The window of a chunk's end begins the next chunk, as far as that has words of its own.
        assert all((a[-4:] + [b"\n"] * 4)[:len(b) - 4][:4] == b[:len(b) - 4][:4] for a, b in zip(own, own[1:]))
        assert not own or own[-1][-4:] == [b"\n"] * 4


@pytest.mark.parametrize("texts", [[], [None], ["", " . "], ["x y z. " * 30], ["a", "x y z. " * 30], ["x y. " * 30, "a", None]])
def test_batches_that_end_with_a_full_part(monkeypatch, texts):
    monkeypatch.setattr(C, "PART", 40)
    batch = pa.record_batch([pa.array(["en"] * len(texts), pa.string()), pa.array(texts, pa.string())], names=["lang", "text"])
    langs, found, own = C._parse(4)()(batch)
    assert len(langs) == len(found) == len(own)
    assert [w for c, n in zip(found.to_pylist(), own) for w in c.encode().split(b" ")[:n]] == [
        w for t in texts for w in plain_tokens(t)]


def test_copies_make_no_new_chunks():
    """A passage of many documents is in the dictionary once, but for chunks with words around it."""
    pick = random.Random(4)
    passage = " ".join(f"w{pick.randint(0, 999)}" for _ in range(2000))
    rows, _ = C.chunks([f"start{i} {passage} end{i}".encode() for i in range(50)], 4)
    inner = {c for c in rows if b"start" not in c and b"end" not in c}
    assert 20 < len(inner) and len(rows) > 49 * len(inner)


def test_hashes_depend_on_bytes_alone():
    data = np.frombuffer(b"abc ab abc b\x00 b c abca", np.uint8)
    words = data.tobytes().split(b" ")
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    found = C.hashes_of(data, start, end).tolist()
    assert all((a == b) == (x == y) for a, x in zip(words, found) for b, y in zip(words, found))


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    pick = random.Random(3)
    rows = [("en", text_of(pick, 60)) for _ in range(20)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(C, "_bitmap", lambda phrases, n: b"\xff" * (C.BITS // 8))
    assert sorted(map(tuple, C.collocations(docs, least=4).collect())) == plain(rows, least=4)


def test_products_beyond_64_bits(spark):
    big = spark.createDataFrame([("en", "x", 1, 5_000_000_000), ("en", "x x", 2, 4_000_000_000)],
                                "lang string, phrase string, size int, f long")
    total = spark.createDataFrame([("en", 9_000_000_000_000)], "lang string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(C, "frequent_phrases", lambda *a: (big, total))
        row = C.collocations(big).first()
    assert row.score == 1000 * 4_000_000_000 * 9_000_000_000_000 // (5_000_000_000 ** 2)


def test_query_and_empty_table(spark):
    folder = f"{TESTDATA}/sf0.001"
    docs = read_table(spark, folder, "documents")
    got = sorted(map(tuple, QUERIES["op12_collocations"](spark, folder).collect()))
    assert got == plain([(r.lang, r.text) for r in docs.collect()]) and got
    assert C.collocations(docs.limit(0)).collect() == []
