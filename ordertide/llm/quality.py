"""Quality classifier: logistic regression on hashed word n-grams.

Features of a text are its words and runs of punctuation and the pairs of
neighbours, once as they are (in lower case) and once as shapes (upper, lower,
title case, digits, mixed, punctuation; a pair also says whether both words are the
same), hashed into ``2 ** BITS`` weights. A value
is log(1 + count), and a text's values have length 1. Weights are trained by
follow-the-regularised-leader updates (per-coordinate steps, L1 and L2) on parts of
about ``SHARD_ROWS`` rows of the sample side by side, and averaged. A score is the logistic
function of the sparse dot product plus a bias.

The sample: at most ``SAMPLE_ROWS`` labelled rows that are not held out, those
with the smallest hash of their id. Every text is scored whole. Empty and null
texts have no features: the bias alone scores them. Without any usable label all
scores are 0.5. Of several labels of one id the smallest counts, of several texts the
smallest teaches. Repeated rows each get their row.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import held_out, map_rows, mix, quoted, type_of
from ordertide.sources.scratch import settle

BITS, SAMPLE_ROWS, SHARD_ROWS, EPOCHS = 18, 16_000, 4000, 16
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.0
BIAS = 1 << BITS  # its weight follows those of the features
TOKEN = re.compile(r"\w+|[^\w\s]+")
SHAPES, SHAPE_BITS = 6, np.uint64(7)


def shape(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return 0
    if token.isdigit():
        return 1
    if token.isupper():
        return 2 if len(token) > 1 else 4
    if token.islower():
        return 3
    return 4 if token.istitle() else 5


class Tokens(dict):
    """Hash of the lower-case token, its last three bits replaced by the shape."""

    def __missing__(self, token: str) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        code = xxhash.xxh3_64_intdigest(token.lower().encode("utf-8", "surrogatepass"))
        value = self[token] = code >> 3 << 3 | shape(token)
        return value


def features(text: str | None, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the features of a text, each once, and their values."""
    found = TOKEN.findall(text or "")
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    codes = np.fromiter(map(tokens.__getitem__, found), np.uint64, len(found))
    shapes = codes & SHAPE_BITS
    words = codes ^ shapes
    wide = np.uint64(0x9E3779B97F4A7C15)
    one = words, words[:-1] * wide + words[1:] + np.uint64(1)
    same = (words[1:] == words[:-1]).astype(np.uint64)
    pair = (shapes[:-1] * np.uint64(SHAPES) + shapes[1:]) * np.uint64(2) + same
    two = shapes + np.uint64(2), pair * wide + np.uint64(3)
    keys, counts = np.unique(
        mix(np.concatenate(one + two)) >> np.uint64(64 - BITS), return_counts=True)
    values = np.log1p(counts)
    return keys.astype(np.int64), values / np.sqrt(values @ values)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights after ``EPOCHS`` passes over (indexes, values, label) in order."""
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)

    def weights(at):
        over = np.maximum(np.abs(z[at]) - L1, 0)
        return -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for index, value, label in rows:
            at, x = np.append(index, BIAS), np.append(value, 1.0)
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            squared = gradient * gradient
            z[at] += gradient - (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squared
    return weights(np.arange(BIAS + 1))


def _features_of():
    tokens = Tokens()

    def step(batch):
        found = [features(t, tokens) for t in batch.column(3).to_pylist()]
        return [*batch.columns[:3], [f[0] for f in found], [f[1] for f in found]]

    return step


def _train(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["rank", "label"], kind="stable")
    weights = ftrl(list(zip(frame["index"], frame["value"], frame["label"])))
    return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> np.ndarray:
    """Weights, the bias last. Every shard holds a bounded part of the bounded sample."""
    ids = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("label"))
    ids = ids.filter("id IS NOT NULL AND label IN (0, 1)").filter(~held_out("id"))
    rank = F.xxhash64(F.col("id").cast("string"))
    sample = settle(ids.groupBy("id").agg(F.min("label").alias("label")).withColumn(
        "rank", rank).orderBy("rank", "id").limit(SAMPLE_ROWS))
    shards = max(1, round(sample.count() / SHARD_ROWS))
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    # SAMPLE_ROWS bounds the broadcast; the texts of other rows are not shuffled.
    rows = texts.join(F.broadcast(sample), "id").groupBy("id", "rank", "label").agg(
        F.min("text").alias("text")).select(  # copies are folded before they meet in a shard
        (F.pmod("rank", F.lit(shards))).cast("int").alias("shard"), "rank", "label", "text")
    coded = map_rows(rows, _features_of, "shard int, rank long, label int, "
                     "index array<long>, value array<double>", 128)
    parts = coded.groupBy("shard").applyInPandas(_train, "weights binary").collect()
    if not parts:
        return np.zeros(BIAS + 1, np.float32)
    return np.mean([np.frombuffer(p["weights"], np.float32) for p in parts], axis=0)


def _score(weights: bytes):
    def make():
        w, tokens = np.frombuffer(weights, np.float32).astype(np.float64), Tokens()

        def step(batch):
            scores = []
            for text in batch.column(1).to_pylist():
                index, value = features(text, tokens)
                scores.append(1 / (1 + np.exp(-np.clip(w[index] @ value + w[BIAS], -35, 35))))
            return [batch.column(0), [float(s) for s in scores]]

        return step

    return make


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Columns ``id_col`` and score of each row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    found = map_rows(rows, _score(weights.astype(np.float32).tobytes()),
                     f"id {type_of(rows, 'id')}, score double")
    return found.withColumnRenamed("id", id_col)
