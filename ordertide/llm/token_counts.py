"""Exact token counts of texts of any length.

A text of up to ``chunk`` code points is encoded whole. A longer one is cut into
overlapping chunks which are encoded as rows of their own, wherever Spark puts
them, with offsets. Neighbours are spliced where both have a pre-token boundary
at the same place of the overlap. Such a place is stable: the splitting pattern
looks only to the right, so from a boundary on the pieces depend on the text
after it alone; byte-pair merges never cross pre-tokens; and boundaries within
``margin`` of a chunk's end, which text not yet seen (or half a special string)
could move, are not used. By induction from the first chunk every splice is a
boundary of the whole text. Texts with a junction that has no common boundary
are encoded again with chunks and overlaps eight times as long, at last whole.

Null and empty texts have 0 tokens. Rows with the same id or text each get their
row; equal long texts are encoded once.
"""

import os
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import map_rows, pairs, type_of
from ordertide.sources.scratch import settle

CHUNK, OVERLAP, GROW = 1 << 16, 1 << 9, 8
MARKS = "array<struct<pos:long,cum:long>>"


@lru_cache(maxsize=2)
def _open(path: str):
    """Read once per Python worker, which Spark uses again for later tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def margin_of(tokenizer) -> int:
    """Code points before a chunk's end in which no boundary is trusted.

    A contraction of the pattern is three characters; a special string may be cut.
    """
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return 4 + max(map(len, added), default=0)


def boundaries(encoding, numbers) -> list[tuple[int, int]]:
    """(place in the chunk, tokens before it) of the pre-tokens that start at these tokens."""
    found = []
    for n in numbers:
        word = encoding.token_to_word(n)
        if n == 0 or word is None or word != encoding.token_to_word(n - 1):
            found.append((encoding.token_to_chars(n)[0], n))
    return found


def ends(encoding, size: int, overlap: int, margin: int):
    """Boundaries in the first ``overlap`` characters of a chunk, and the trusted ones in the last."""
    count, first = len(encoding), 0
    while first < count and encoding.token_to_chars(first)[0] <= overlap:
        first += 1
    last = count
    while last > 0 and encoding.token_to_chars(last - 1)[0] >= size - overlap:
        last -= 1
    tail = boundaries(encoding, range(last, count))
    return boundaries(encoding, range(first)), [b for b in tail if b[0] <= size - margin]


def _whole(path: str):
    def make():
        tokenizer = _open(path)

        def step(batch):
            texts = batch.column(1).to_pylist()
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [batch.column(0), [len(t.encode()) for t in texts], [len(e) for e in found]]

        return step

    return make


def _cut(chunk: int, overlap: int):
    """Rows (key, number, last, start, piece) of each text."""
    def make():
        def step(batch):
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts = range(0, max(1, len(text) - overlap), chunk - overlap)
                for n, s in enumerate(starts):
                    rows.append((key, n, n == len(starts) - 1, s, text[s:s + chunk]))
            return [list(c) for c in zip(*rows)] if rows else [[]] * 5

        return step

    return make


def _encode_pieces(path: str, overlap: int):
    """Boundaries in the head and the tail of each chunk, and its token count."""
    def make():
        tokenizer = _open(path)
        margin = margin_of(tokenizer)

        def step(batch):
            starts, pieces = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            heads, tails, totals = [], [], []
            for start, piece in zip(starts, pieces):
                encoding = tokenizer.encode(piece, add_special_tokens=False)
                for marks, out in zip(ends(encoding, len(piece), overlap, margin), (heads, tails)):
                    out.append([{"pos": start + at, "cum": n} for at, n in marks])
                totals.append(len(encoding))
            return [batch.column(0), batch.column(1), batch.column(2), heads, tails, totals]

        return step

    return make


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Columns key and n_tokens; n_tokens is null where a junction has no common boundary."""
    cut = "key string, number long, last boolean, start long, piece string"
    # One shuffle spreads the chunks of a huge text and drops those of equal texts.
    rows = map_rows(texts, _cut(chunk, overlap), cut, 8).dropDuplicates(["key", "number"])
    coded = map_rows(
        rows, _encode_pieces(path, overlap),
        f"key string, number long, last boolean, head {MARKS}, tail {MARKS}, total long", 16)
    none = F.lit(None).cast(MARKS)
    ends = F.array(
        F.struct(F.col("number").alias("at"), none.alias("tail"), F.col("head"),
                 F.lit(None).cast("long").alias("total")),
        F.struct((F.col("number") + 1).alias("at"), F.col("tail"), none.alias("head"),
                 F.when(F.col("last"), F.col("total")).alias("total")),
    )
    sides = coded.select("key", F.explode(ends).alias("e")).select("key", "e.*")
    met = sides.filter(F.col("at") > 0).groupBy("key", "at").agg(
        F.max("tail").alias("tail"), F.max("head").alias("head"), F.max("total").alias("total"))
    common = F.expr("""
        filter(transform(tail, t -> t.cum - try_element_at(filter(head, h -> h.pos = t.pos), 1).cum),
               d -> d IS NOT NULL)""")
    part = F.coalesce("total", F.try_element_at(common, F.lit(1)))
    return met.select("key", part.alias("part")).groupBy("key").agg(
        F.when(F.count("part") == F.count(F.lit(1)), F.sum("part")).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Columns ``id_col``, n_bytes and n_tokens for each row of ``docs``."""
    if chunk < 2 * overlap:
        raise ValueError("a chunk must be at least two overlaps long")
    rows = pairs(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    kind = type_of(rows, "id")
    long_text = F.length("text") > chunk
    counted = map_rows(rows.filter(~long_text), _whole(path),
                       f"id {kind}, n_bytes long, n_tokens long", 256)

    long_rows = rows.filter(long_text).withColumn("key", F.sha2("text", 256))
    texts, done = long_rows.select("key", "text"), None
    while True:
        found = settle(_spliced(texts, path, chunk, overlap))
        ready = found.filter("n_tokens IS NOT NULL")
        done = ready if done is None else done.unionByName(ready)
        failed = found.filter("n_tokens IS NULL").select("key")
        if failed.isEmpty():
            break
        texts = texts.join(failed, "key", "left_semi")
        chunk, overlap = chunk * GROW, overlap * GROW
    joined = long_rows.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes"))
    joined = joined.join(done, "key").select("id", "n_bytes", "n_tokens")
    return counted.unionByName(joined).withColumnRenamed("id", id_col)
