"""Quality scores: held-out accuracy, and the updates against a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ordertide.llm import quality as Q
from ordertide.llm.common import read_table
from ordertide.llm.queries import QUERIES
from tests.comparing import TESTDATA

SCHEMA = "doc_id long, text string, score string"


def test_held_out_accuracy(spark):
    folder = f"{TESTDATA}/sf0.1"
    scored = QUERIES["op2_quality_scores"](spark, folder)
    both = scored.join(read_table(spark, folder, "labels"), "doc_id").filter("held_out")
    right, n = both.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert n > 1000 and right > 0.97
    assert scored.filter("score < 0 OR score > 1 OR (score >= 0.5) <> (predicted = 1)").isEmpty()


def test_updates_equal_plain_dictionaries():
    pick = random.Random(4)
    rows = [(np.array(sorted(pick.sample(range(30), 4))), np.array([pick.random() for _ in range(4)]),
             pick.randint(0, 1)) for _ in range(40)]
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= Q.L1:
            return 0.0
        return -(z[i] - math.copysign(Q.L1, z[i])) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2)

    for _ in range(Q.EPOCHS):
        for index, value, label in rows:
            x = [*zip(index.tolist(), value.tolist()), (Q.BIAS, 1.0)]
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (p - label) * v
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / Q.ALPHA
                z[i] = z.get(i, 0.0) + g - s * w[i]
                n[i] = n.get(i, 0.0) + g * g
    got = Q.ftrl(rows)
    assert all(abs(got[i] - weight(i)) < 1e-9 for i in [*range(31), Q.BIAS])


def test_edge_cases(spark):
    rows = [(i, "good plain words here" if i % 2 else "bad ## $$ ##", "x") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "good plain", "x"), (102, "bad ## " * 50_000, "x"), (102, "é", "x")]
    labels = [(i, i % 2) for i in range(60)] + [(1, 0), (5, None), (None, 1), (999, 1)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    weights = Q.train(docs, marks)
    got = Q.score(docs, weights).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc_id: r.score for r in got}
    assert scores[100] == scores[101] and scores[None] > 0.5
    twice = [r.score for r in got if r.doc_id == 102]
    assert len(twice) == 2 and min(twice) < 0.5
    assert scores[3] > 0.5 > scores[2]
    empty = Q.train(docs, marks.limit(0))
    assert {r.score for r in Q.score(docs, empty).collect()} == {0.5}
    assert Q.score(docs.limit(0), weights).collect() == []
    assert np.array_equal(Q.train(docs.repartition(5), marks.repartition(3)), weights)


def test_copies_of_sampled_rows_teach_once(spark):
    """A third of all rows are one labelled document; what it teaches is what one row would."""
    rows = [(i, f"good plain words {i}" if i % 2 else f"bad ## $$ {i}", "x") for i in range(60)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    one = Q.train(spark.createDataFrame(rows, SCHEMA), marks)
    many = Q.train(spark.createDataFrame(rows + [rows[2]] * 3000 + [(2, "zz", "y")] * 3000, SCHEMA), marks)
    assert np.array_equal(one, many)


WHOLE = 1 << 64


def plain_mix(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor % WHOLE
    return x ^ x >> 31


def plain_features(text):
    """{place: value}: places counted in a dictionary, damped and brought to length 1."""
    found = re.findall(r"\w+|[^\w\s]+", text or "")
    words = [xxhash.xxh3_64_intdigest(t.lower()) // 8 * 8 for t in found]
    shapes = [Q.shape(t) for t in found]
    wide, counts = 0x9E3779B97F4A7C15, Counter()
    counts.update(words)
    counts.update(s + 2 for s in shapes)
    for k in range(len(found) - 1):
        pair = 2 * (Q.SHAPES * shapes[k] + shapes[k + 1]) + (words[k] == words[k + 1])
        counts.update([(words[k] * wide + words[k + 1] + 1) % WHOLE, (pair * wide + 3) % WHOLE])
    places = Counter()
    for key, n in counts.items():
        places[plain_mix(key) >> 64 - Q.BITS] += n
    values = {k: math.log(1 + n) for k, n in places.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {k: v / length for k, v in values.items()}


def test_features_and_scores_equal_plain_dictionaries(spark):
    texts = ["One two TWO, one two!! 12 x_1 Éa", "", None, "a", "## a a a ##", " \n", "Mixed CaseWords 日本 " * 50]
    weights = np.random.default_rng(1).normal(0, 3, Q.BIAS + 1).astype(np.float32)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {r.doc_id: r.score for r in Q.score(docs, weights).collect()}
    for i, text in enumerate(texts):
        want = plain_features(text) if (text or "").split() else {}
        index, value = Q.features(text, Q.Tokens())
        assert index.tolist() == sorted(want) and np.allclose(value, [want[k] for k in index.tolist()])
        logit = sum(float(weights[k]) * v for k, v in want.items()) + float(weights[Q.BIAS])
        assert abs(scores[i] - 1 / (1 + math.exp(-logit))) < 1e-9
