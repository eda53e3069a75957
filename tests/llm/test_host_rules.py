"""Base measures against plain counting; host verdicts against the formula."""

import random
import re

from ordertide.llm import host_rules

SCHEMA = "doc_id long, text string, source string, n_words string"


def plain(text):
    text = text or ""
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^ \t\n\x0b\x0c\r]", line):
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, len(covered))


def texts():
    pick = random.Random(2)
    parts = ["a", "b", "cc", "é日", "#*", "\n", " ", "\t", "x y", "\r\n", "|", "a b c\n"]
    made = [" ".join(pick.choice(parts) for _ in range(pick.randint(0, 150))) for _ in range(60)]
    return made + ["", None, "\n\n", "w " * 20_000, "\x0b\x0c", "one two three one two three"]


def run(spark, rows, **more):
    return host_rules.apply_rules(spark.createDataFrame(rows, SCHEMA), **more).collect()


def test_measures(spark):
    rows = [(i, t, f"h{i % 3}", "x") for i, t in enumerate(texts()) if i != 63]
    got = {r.doc_id: r for r in run(spark, rows)}
    for i, t, _, _ in rows:
        r = got[i]
        want = plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_long_text():
    assert host_rules.measure("w " * 20_000)[:5] == (20_000, 20_000, 0, 0, 20_000)
    many = " ".join(f"w{n}" for n in range(1_300_000)) + " w0 w1 w2"
    assert host_rules.measure(many)[4] == 6


def test_hosts(spark):
    good = " ".join(f"word{n}" for n in range(60))
    rows = [(i, good, "good", "") for i in range(30)] + [(100 + i, "bad", "bad", "") for i in range(30)]
    rows += [(200, good, "bad", ""), (201, good, None, ""), (202, good, "new", ""), (203, "x", "new", ""),
             (203, "x", "new", "")]
    got = {r.doc_id: r for r in run(spark, rows)}
    assert got[0].kept and got[201].kept and got[201].host_rejected is None
    assert not got[100].kept and not got[200].kept and got[200].host_rejected and not got[200].base_failed
    rates = {"good": (0, 30), "bad": (30, 31), "new": (2, 3)}
    each = [x / n for x, n in rates.values()]
    mean = sum(each) / 3
    weight = mean * (1 - mean) / (sum((e - mean) ** 2 for e in each) / 3) - 1
    new = (2 + mean * weight) / (3 + weight)
    assert got[202].host_rejected == (new > 0.5)
    assert run(spark, []) == []
    alike = run(spark, [(1, good, "a", ""), (2, good, "b", "")])
    assert all(r.kept for r in alike)
