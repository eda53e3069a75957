"""Removal of repeated line runs with a suffix array over line ids.

A suffix starts at a line of a document and runs to the end of its stretch of
lines that occur more than once in the corpus (no repeated run can leave such a
stretch). Suffixes are ranked by distributed prefix doubling: round 0 ranks single
lines, round k ranks pairs of ranks 2**(k-1) lines apart, so that suffixes of equal
rank share their first 2**k lines. Each round numbers the distinct pairs in their
global order: a range-partitioned sort, running sums inside the partitions and one
offset per partition.

Suffixes that share a prefix stand side by side in the suffix array; they form an
interval of longest common prefixes. A run counts when it has ``min_words`` words.
For each suffix the least number of lines with that many words is its need, and two
overlapping ranks tell which suffixes share a prefix of that length. The interval's
first suffix in the order of (id, text, line) is the original; all others are later
copies, and the lines of their prefix are deleted. A maximal repeated run is the
union of these prefixes, so it goes as a whole, wherever it starts.

Lines are what ``\\n`` separates, compared as they are; words are separated by ASCII
white space. A null text has no lines and stays null. Rows with the same id and text
count once and all get the same result; null ids sort first. A document all of
whose lines are copies becomes empty.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordertide.llm.common import few_files, map_rows, quoted, type_of
from ordertide.sources.scratch import settle

MIN_WORDS = 50
SHARES, SPREAD = 1000, 64  # a line with that share of all repeated ones is dealt to so many tasks


def _lines():
    import xxhash

    def step(batch):
        owner, number, digest, words = [], [], [], []
        for n, text in enumerate(batch.column(2).to_pylist()):
            if text is None:
                continue
            for i, line in enumerate(text.encode("utf-8").split(b"\n")):
                owner.append(n)
                number.append(i)
                digest.append(xxhash.xxh3_128_digest(line))
                words.append(len(line.split()))
        take = pa.array(owner, pa.int64())
        return [batch.column(0).take(take), batch.column(1).take(take), number, digest, words]

    return step


def key_of(id_col: str, text_col: str) -> Column:
    """Digest of id and text."""
    id_ = quoted(id_col)
    text = F.concat_ws("|", id_.isNull().cast("string"), id_.cast("string"), quoted(text_col))
    return F.unhex(F.md5(text))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns doc (digest of id and text), id and text."""
    return docs.select(key_of(id_col, text_col).alias("doc"), quoted(id_col).alias("id"),
                       quoted(text_col).alias("text"))


def _stretches(min_words: int):
    """Rows (doc, id, stretch, line number, line, need) of stretches with enough words."""
    def make():
        def step(batch):
            owner, stretch, number, line, need = [], [], [], [], []
            for n, rows in enumerate(batch.column(2).to_pylist()):
                at = np.array([r["i"] for r in rows])
                words = np.array([r["words"] for r in rows])
                cuts = np.flatnonzero(np.diff(at) != 1) + 1
                for a, b in zip([0, *cuts], [*cuts, len(rows)]):
                    total = np.cumsum(words[a:b])
                    if total[-1] < min_words:
                        continue
                    before = total - words[a:b]
                    last = np.searchsorted(total, before + min_words)
                    lines = np.where(last < b - a, last - np.arange(b - a) + 1, 0)
                    owner += [n] * int(b - a)
                    stretch += [int(at[a])] * int(b - a)
                    number += at[a:b].tolist()
                    line += [r["line"] for r in rows[a:b]]
                    need += lines.tolist()
            take = pa.array(owner, pa.int64())
            return [batch.column(0).take(take), batch.column(1).take(take),
                    stretch, number, line, need]

        return step

    return make


def _running():
    """Running sums of the counts inside this partition, and the partition's number."""
    state = {"sum": 0}
    part = TaskContext.get().partitionId()

    def step(batch):
        counts = batch.column(2).to_numpy()
        before = state["sum"] + np.cumsum(counts) - counts
        state["sum"] += int(counts.sum())
        return [*batch.columns, before, [part] * len(counts)]

    return step


def ranked(pairs: DataFrame, count: int) -> DataFrame:
    """Columns a, b and rank: how many suffixes stand before the pair's first in global order.

    ``count``: the number of suffixes, which bounds that of distinct pairs.
    """
    spark = pairs.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), count // 250_000 + 1)
    classes = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    ordered = classes.repartitionByRange(parts, "a", "b").sortWithinPartitions("a", "b")
    summed = settle(map_rows(ordered, _running, f"a {type_of(pairs, 'a')}, b long, n long, "
                             "before long, part int", 1 << 16))
    sums = summed.groupBy("part").agg(F.sum("n").alias("n")).collect()  # a row per partition
    offsets, total = [], 0
    for row in sorted(sums, key=lambda r: r["part"]):
        offsets.append((row["part"], total))
        total += row["n"]
    table = spark.createDataFrame(offsets, "part int, offset long")
    return summed.join(F.broadcast(table), "part").select(
        "a", "b", (F.col("before") + F.col("offset")).alias("rank"))


def suffix_ranks(starts: DataFrame, rounds: int) -> DataFrame:
    """``starts`` with the columns r0 .. r<rounds>; equal rk: the first 2**k lines are equal.

    A suffix that ends before 2**k lines has the rank of what is left, before all
    suffixes that continue it.
    """
    stretch = Window.partitionBy("doc", "stretch").orderBy("i")
    rows, column, gap, count = starts, F.col("line"), 0, starts.count()
    for k in range(rounds + 1):
        then = F.coalesce(F.lead(f"r{k - 1}", gap).over(stretch), F.lit(-1)) if k else F.lit(0)
        paired = rows.withColumn("a", column).withColumn("b", then.cast("long"))
        known = ranked(paired.select("a", "b"), count)
        rows = paired.join(known, ["a", "b"]).drop("a", "b", "line").withColumnRenamed("rank", f"r{k}")
        rows = settle(few_files(rows, count, 250_000))
        column, gap = F.col(f"r{k}"), 1 << k
    return rows


def _found_in(lines: DataFrame, often: DataFrame) -> DataFrame:
    """The lines that ``often`` has; those with a large share of all go to many tasks each.

    At most ``SHARES`` lines can have a share of one in ``SHARES``, so they can be broadcast.
    """
    total = often.agg(F.sum("n")).first()[0] or 0
    hot = often.filter(F.col("n") * SHARES >= total).select("line", F.lit(True).alias("hot"))
    spread = F.when(F.col("hot"), F.pmod(F.xxhash64("doc"), F.lit(SPREAD))).otherwise(0)
    marked = lines.join(F.broadcast(hot), "line", "left").withColumn("salt", spread.cast("int")).drop("hot")
    salts = F.when(F.col("n") * SHARES >= total, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    return marked.join(often.select("line", F.explode(salts).alias("salt")), ["line", "salt"], "left_semi").drop("salt")


def copies(docs: DataFrame, min_words: int) -> DataFrame:
    """Columns doc and cuts: array of (first line, number of lines) of later copies."""
    kind = type_of(docs, "id")
    lines = map_rows(docs, _lines, f"doc binary, id {kind}, i long, line binary, words long")
    # A line at two places at least; copies of a row have the same places and count once.
    place = F.xxhash64("doc", "i")
    often = settle(lines.groupBy("line").agg(
        F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n")).filter("a <> b"))
    repeated = _found_in(lines, often)
    # A set: of a row that is there many times, each task gives its lines once.
    per_doc = repeated.groupBy("doc", "id").agg(F.sort_array(
        F.collect_set(F.struct("i", "line", "words"))).alias("rows"))
    starts = settle(map_rows(
        per_doc, _stretches(min_words),
        f"doc binary, id {kind}, stretch long, i long, line binary, need long"))
    top = starts.agg(F.max("need")).first()[0] or 0
    if not top:
        return starts.select("doc", F.expr(
            "cast(array() as array<struct<i:long,need:long>>)").alias("cuts")).limit(0)
    rounds = int(top).bit_length() - 1
    ranks = suffix_ranks(starts, rounds)

    # A prefix of `need` lines is told by two ranks of the largest power of two in it:
    # one at its first line, one that ends with its last.
    def of_level(column):
        found = F.lit(None)
        for k in range(rounds + 1):
            found = F.when(F.col("need") >= 1 << k, column(k)).otherwise(found)
        return found

    asked = ranks.filter("need > 0").select(
        "doc", "id", "i", "need", of_level(lambda k: F.lit(k)).cast("int").alias("level"),
        of_level(lambda k: F.col(f"r{k}")).cast("long").alias("head"),
        of_level(lambda k: F.col("i") + F.col("need") - (1 << k)).cast("long").alias("at"))
    every = ranks.select("doc", F.col("i").alias("at"), *[f"r{k}" for k in range(rounds + 1)])
    told = asked.join(every, ["doc", "at"]).withColumn(
        "tail", of_level(lambda k: F.col(f"r{k}")).cast("long"))
    interval = ["level", "need", "head", "tail"]
    place = F.struct("id", "doc", "i")
    first = told.groupBy(*interval).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    later = told.join(first.filter("n > 1"), interval).filter(place != F.col("first"))
    return later.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("i", "need"))).alias("cuts"))


def removed_lines(cuts, count: int) -> np.ndarray:
    gone = np.zeros(count, bool)
    for first, need in cuts or []:
        gone[first:first + need] = True
    return gone


def runs(gone: np.ndarray) -> str:
    """Deleted lines as "first-last" ranges."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return ",".join(f"{a}-{b - 1}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))


def cut(text: str | None, cuts) -> tuple[int, np.ndarray, str | None]:
    """Number of lines, which are deleted, and the text that is left."""
    lines = [] if text is None else text.split("\n")
    gone = removed_lines([(c["i"], c["need"]) for c in cuts or []], len(lines))
    kept = "\n".join(x for x, g in zip(lines, gone) if not g) if gone.any() else text
    return len(lines), gone, kept


def _report():
    def step(batch):
        found = [cut(t, c) for t, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        return [batch.column(0), [n for n, _, _ in found], [int(g.sum()) for _, g, _ in found],
                [runs(g) for _, g, _ in found], [kept for _, _, kept in found]]

    return step


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """Per row ``id_col``, n_lines, n_removed, removed (line ranges) and the text that is left."""
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(copies(rows, min_words), "doc", "left").select("id", "text", "cuts")
    found = map_rows(joined, _report, f"id {type_of(rows, 'id')}, n_lines long, n_removed long, "
                     "removed string, text string")
    return found.withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS, length_col: str | None = None) -> DataFrame:
    """All rows and columns with copied lines taken out of the text.

    Rows that lose all their lines go. ``length_col`` gets the new text's code points.
    """
    rows = keyed(docs, id_col, text_col)
    found, schema = copies(rows, min_words), docs.schema
    at, length_at = docs.columns.index(text_col), docs.columns.index(length_col) if length_col else -1
    key = key_of(id_col, text_col).alias("doc")
    struct = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    joined = docs.select(key, struct).join(found, "doc", "left")
    names = [f"c{n}" for n in range(len(docs.columns))]
    flat = joined.select(*[F.col("row").getField(c).alias(n) for c, n in zip(docs.columns, names)], "cuts")

    def make():
        def step(batch):
            columns = list(batch.columns[:-1])
            done = [cut(t, c) for t, c in zip(columns[at].to_pylist(), batch.column(len(names)).to_pylist())]
            columns[at] = pa.array([kept for _, _, kept in done], pa.string())
            if length_at >= 0:
                size = pa.array([None if k is None else len(k) for _, _, k in done], pa.int64())
                columns[length_at] = size.cast(batch.schema.field(length_at).type)
            left = pa.array([not n or bool((~gone).any()) for n, gone, _ in done], pa.bool_())
            return [c.filter(left) for c in columns]

        return step

    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema.fields))
    return map_rows(flat, make, kinds).toDF(*docs.columns)
