"""Quality rules judged by document and by host.

Each text is measured once. Per host (domain, or source) the failures of every
rule are counted, and the rate of each is shrunk towards the mean of all hosts by
a beta prior fitted to the hosts' rates (method of moments). A host whose shrunk
rate of some rule is above ``limit`` is rejected, and the verdict is joined back:
a document stays if it passes the base rule and its host is not rejected.

Null texts have no words. Documents without a host are judged on their own (their
host verdict is null). Repeated rows count once each and each gets its row.
"""

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import WORD, map_rows, quoted, type_of
from ordertide.sources.scratch import settle

# Base measures and the base rule.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 50, 50, 3
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Rules whose failures are counted per host: name and SQL condition of a failure.
RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines >= 5 AND 5 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)",
}

_word, _has_word = re.compile(WORD), re.compile(WORD).search


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three that is found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    size = len(ids)
    first = codes[:-2] * size + codes[1:-1]
    if size ** 3 < 1 << 62:
        key = first * size + codes[2:]
    else:  # name the pairs first, so that keys of very long texts still fit
        key = np.unique(first, return_inverse=True)[1].astype(np.int64) * size + codes[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(WINDOW):
        covered[shift:n + shift] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The five measures and the number of lines with a word."""
    text = text or ""
    words = _word.findall(text)
    lines = [line for line in text.split("\n") if _has_word(line)]
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines))


def _measure_all():
    def step(batch):
        rows = [measure(t) for t in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), *(list(c) for c in zip(*rows))]

    return step


def measures(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    rows = docs.select(quoted(id_col).alias("id"), quoted(host_col).alias("host"),
                       quoted(text_col).alias("text"))
    columns = ", ".join(f"{m} long" for m in [*MEASURES, "n_lines"])
    found = map_rows(rows, _measure_all,
                     f"id {type_of(rows, 'id')}, host {type_of(rows, 'host')}, {columns}")
    return found.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"))


def host_counts(measured: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per host: documents and failures of each rule."""
    fails = [F.sum(F.expr(f"CASE WHEN {sql} THEN 1L ELSE 0L END")).alias(name)
             for name, sql in rules.items()]
    return measured.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *fails)


def beta_priors(counts: DataFrame, rules: dict[str, str]) -> dict[str, tuple[float, float]]:
    """Per rule the beta prior whose mean and variance are those of the hosts' rates.

    Where rates do not vary (or there are fewer than two hosts) the prior has the
    weight of one mean host, ``mean * n_docs`` of it failures.
    """
    sums = [F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("docs")]
    for r in rules:
        rate = F.col(r) / F.col("n_docs")
        sums += [F.sum(r).alias(f"{r}_failed"), F.avg(rate).alias(f"{r}_mean"),
                 F.var_pop(rate).alias(f"{r}_var")]
    row = counts.agg(*sums).first()
    priors = {}
    for r in rules:
        mean, var = row[f"{r}_mean"] or 0.0, row[f"{r}_var"] or 0.0
        if 0 < var < mean * (1 - mean):
            weight = mean * (1 - mean) / var - 1
        else:
            weight = row["docs"] / row["hosts"] if row["hosts"] else 1.0
        priors[r] = (mean * weight, (1 - mean) * weight)
    return priors


def judge_hosts(counts: DataFrame, rules: dict[str, str], limit: float) -> DataFrame:
    """Columns host, host_rejected and the shrunk rate of each rule."""
    priors = beta_priors(counts, rules)
    rates = [((F.col(r) + a) / (F.col("n_docs") + a + b)).alias(f"rate_{r}")
             for r, (a, b) in priors.items()]
    worst = F.greatest(*[F.col(f"rate_{r}") for r in rules], F.lit(0.0))
    return counts.select("host", "n_docs", *rates).withColumn("host_rejected", worst > limit)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source", rules: dict[str, str] | None = None,
                limit: float = 0.5) -> DataFrame:
    """Per row its measures, base_failed, host_rejected (null without host) and kept."""
    rules = RULES if rules is None else rules
    measured = settle(measures(docs, id_col, text_col, host_col))
    verdicts = judge_hosts(host_counts(measured, rules), rules, limit)
    kept = ~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))
    judged = measured.join(verdicts.select("host", "host_rejected"), "host", "left")
    return judged.select(F.col("id").alias(id_col), *MEASURES, "base_failed", "host_rejected",
                         kept.alias("kept"))
