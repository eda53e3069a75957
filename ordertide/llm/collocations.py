"""Phrase collocations, counted through a prefix-free parse.

The words of a text, with a break wherever a piece ends, are parsed into chunks: a chunk
ends with each window of WINDOW tokens whose hash is 0 modulo ``TRIGGER``, and the next
chunk begins with that same window, so where chunks end depends on the words around
alone and equal passages fall into equal chunks wherever they stand. The distinct chunks
of a language with their frequencies are the dictionary of the parse. Neighbours share a
window one token shorter than the longest phrase, so every phrase lies whole in a chunk;
it is counted in the chunk that it begins in before the closing window, times the
chunk's frequency, and so once for every place in the texts. A passage found in a
thousand documents is looked at once.

Phrases are counted by length. A phrase can only reach ``least`` if its parts without the
first and without the last word did, so longer ones are counted only where both are in a
bitmap of those found before. After pairs only the stretches of chunks are kept in which
all neighbours are such pairs. The bitmap has a fixed size (``BITS``); it says yes too often
when it fills up, which costs rows and no exactness. Counts are by the words themselves.

A phrase of two words and more is cut into two in the place where 1000 a n / (l r),
rounded down, is least (a, l, r: places of the phrase and its parts, n: words of the
language); that is its score. It is left out if a candidate with one word more around it
has at least ``covered`` per cent of its places. (If a still longer one has, so has the
part of it that is one word longer.)

A-Z are lower-cased, pieces end at ``.,;:!?`` and ASCII line ends, words at spaces and tabs.
A null text has no words, a null language is ``und``. Repeated rows count again. Phrases
with equal scores are ordered by frequency and then by their bytes. Texts over ``PART`` bytes
are parsed in parts that end with a piece, which loses nothing, as no phrase goes on
there; a piece without any trigger is one chunk, however long.
"""

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ordertide.llm.common import map_rows, mix, quoted
from ordertide.sources.scratch import settle

LONGEST, LEAST, TOP, COVERED = 5, 100, 2000, 100
TRIGGER = 32  # mean number of tokens that a chunk has of its own
BITS, PAGE = 1 << 25, 1 << 15  # 4 MB of bitmap in pages of 4 KB, as Spark builds them
PART, ROWS = 1 << 20, 4096  # bytes of text, and chunks, that are looked at together
SPACE, BREAK = 0x20, 0x0A  # tokens are separated by spaces; a break is a token that no word can be
UNKNOWN = "und"

_UPPER, _ENDS = bytes(range(65, 91)), b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_UPPER + _ENDS + b"\t", _UPPER.lower() + b"\n" * len(_ENDS) + b" ")


# -- hashing ---------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _many_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    odd = 0x9E3779B97F4A7C15
    inverse = pow(odd, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, x, np.uint64)]), dtype=np.uint64)
                 for x in (odd, inverse))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least so many; what parts of usual length need is made once."""
    return _many_powers(max(2 * PART, 1 << size.bit_length()))


def hashes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes, from sums over all bytes before its ends."""
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` codes."""
    found = np.zeros(max(0, len(codes) - width + 1), np.uint64)
    for k in range(width):
        found = mix(found + codes[k:k + len(found)])
    return found


# -- parsing -----------------------------------------------------------------------


def parts_of(text: str | None) -> list[bytes]:
    """The bytes of a text, lower-cased; long ones in parts that end where a piece ends."""
    data, found = (text or "").encode("utf-8").translate(_PLAIN), []
    while len(data) > PART:
        cut = data.find(b"\n", PART)
        if cut < 0:
            break
        found.append(data[:cut + 1])
        data = data[cut + 1:]
    return [*found, data]


def streams(parts: list[bytes], window: int) -> tuple[bytes, np.ndarray]:
    """The tokens of all parts, each followed by a space, and how many each part has.

    A break follows each piece that has a word, and ``window`` more follow the last.
    """
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    inside = (data != SPACE) & (data != BREAK)
    first = np.zeros(len(data) + 1, bool)  # whether a part begins here
    first[0] = first[ends] = True
    start = np.flatnonzero(inside & (first[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (first[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    part = np.searchsorted(ends, start, "right")
    last = np.concatenate([part[1:] != part[:-1], [True]])[:len(start)]
    lines = np.flatnonzero(data == BREAK)
    broken = last.copy()
    broken[:-1] |= np.searchsorted(lines, end[:-1]) != np.searchsorted(lines, start[1:])
    size = end - start
    place = np.cumsum(size + 1 + 2 * broken + 2 * window * last)
    total, place = int(place[-1]) if len(place) else 0, np.concatenate([[0], place[:-1]])
    out = np.full(total, SPACE, np.uint8)
    source = np.flatnonzero(inside)
    out[source + np.repeat(place - start, size)] = data[source]
    after = place + size + 1
    out[after[broken]] = BREAK
    for k in range(window):
        out[after[last] + 2 + 2 * k] = BREAK
    tokens = np.bincount(part, weights=1 + broken + window * last, minlength=len(parts))
    return out.tobytes(), tokens.astype(np.int64)


def chunks(parts: list[bytes], window: int) -> tuple[list[bytes], np.ndarray]:
    """The parse of all parts, and the part that each chunk is of.

    Every chunk ends with the ``window`` tokens that the next begins with, the last
    one of a part with as many breaks.
    """
    stream, tokens = streams(parts, window)
    data = np.frombuffer(stream, np.uint8)
    end = np.flatnonzero(data == SPACE)
    start = np.concatenate([[0], end[:-1] + 1])[:len(end)]
    triggers = np.flatnonzero(rolled(hashes_of(data, start, end), window) % np.uint64(TRIGGER) == 0)
    part = np.repeat(np.arange(len(parts)), tokens)
    stop = np.cumsum(tokens)
    used = np.flatnonzero(tokens)
    begin, close = stop[used] - tokens[used], stop[used] - window  # the window at the very end closes a part
    triggers = triggers[triggers < (stop - window)[part[triggers]]]
    bounds = np.unique(np.concatenate([begin, triggers, close]))
    whole = ~np.isin(bounds, close)[:-1]
    a, b = bounds[:-1][whole], bounds[1:][whole]
    return [stream[x:y] for x, y in zip(start[a].tolist(), end[b + window - 1].tolist())], part[a]


def _parse(window: int):
    def step(batch):
        langs, found, own = [], [], []

        def add(parts, of):
            made, part = chunks(parts, window)
            found.extend(made)
            langs.extend(of[p] for p in part.tolist())

        parts, of, size = [], [], 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for data in parts_of(text):
                parts.append(data)
                of.append(lang)
                size += len(data)
                if size > PART:
                    add(parts, of)
                    parts, of, size = [], [], 0
        if parts:
            add(parts, of)
        own = [c.count(b" ") + 1 - window for c in found]
        return [langs, pa.array(found, pa.binary()).cast(pa.string()), own]

    return lambda: step


# -- counting ----------------------------------------------------------------------


def stretches(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes from each start to its end, as text."""
    size = end - start
    ends = np.cumsum(size)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    made = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])
    return made.cast(pa.string())


class Tokens:
    """The tokens of a batch of chunks (columns lang, chunk, own, times), one after the other."""

    def __init__(self, batch: pa.RecordBatch):
        text = batch.column(1).cast(pa.large_binary())
        bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        raw = text.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[bounds[0]:bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        spaces = np.flatnonzero(self.data == SPACE)
        self.end = np.sort(np.concatenate([spaces, bounds[1:]]), kind="stable")
        spaced = np.concatenate([self.data, [0]])[self.end[:-1]] == SPACE
        self.start = np.concatenate([[0], self.end[:-1] + spaced])[:len(self.end)]
        size = np.diff(np.searchsorted(spaces, bounds)) + 1
        self.row = np.repeat(np.arange(len(size)), size)
        number = np.arange(len(self.row)) - np.repeat(np.cumsum(size) - size, size)
        self.left = size[self.row] - number
        self.own = number < batch.column(2).to_numpy()[self.row]
        self.is_word = (self.data[self.start] != BREAK) | (self.end - self.start > 1)
        self.codes = hashes_of(self.data, self.start, self.end)
        self.lang, self.times = batch.column(0).dictionary_encode(), batch.column(3).to_numpy()
        names = [np.frombuffer(n.encode("utf-8"), np.uint8) for n in self.lang.dictionary.to_pylist()]
        ends = np.cumsum([len(n) for n in names], dtype=np.int64)
        seeds = hashes_of(np.concatenate([*names, np.zeros(0, np.uint8)]), ends - [len(n) for n in names], ends)
        self.of = self.lang.indices.to_numpy()
        self.seed = seeds[self.of]

    def hashes(self, n: int) -> np.ndarray:
        """A hash of the language and the ``n`` words from each token on."""
        found = rolled(self.codes, n)
        return mix(found + self.seed[self.row[:len(found)]])

    def known(self, n: int, bitmap: np.ndarray) -> np.ndarray:
        """Whether the bitmap has the ``n`` words from each token on."""
        code = self.hashes(n) % np.uint64(BITS)
        found = np.zeros(len(self.row), bool)
        found[:len(code)] = (bitmap[code >> np.uint64(3)] >> (code & np.uint64(7)).astype(np.uint8)) & 1
        return found

    def starts(self, n: int) -> np.ndarray:
        """Tokens that ``n`` words of one piece begin at, each place of a text in one chunk."""
        good = self.own & (self.left >= n)
        for k in range(n):
            good[:len(good) - k] &= self.is_word[k:]
        return np.flatnonzero(good)

    def counted(self, at: np.ndarray, n: int) -> pa.Table:
        """Distinct phrases of ``n`` words at these tokens, with their frequency."""
        table = pa.table({
            "lang": pa.array(self.of[self.row[at]]), "phrase": stretches(self.data, self.start[at], self.end[at + n - 1]),
            "f": pa.array(self.times[self.row[at]], pa.int64())})
        found = table.group_by(["lang", "phrase"]).aggregate([("f", "sum")]).combine_chunks()
        return pa.table({"lang": self.lang.dictionary.take(found["lang"].combine_chunks()),
                         "phrase": found["phrase"], "f": found["f_sum"]})


def _bits(bitmap) -> np.ndarray | None:
    return None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)


def _count(n: int, bitmap):
    """Frequencies of phrases of ``n`` words whose two parts are in the bitmap, if there is one.

    With single words comes a row per language without a phrase: the number of words.
    """
    def make():
        seen = _bits(bitmap)

        def step(batch):
            tokens = Tokens(batch)
            at = tokens.starts(n)
            if seen is not None:
                known = tokens.known(n - 1, seen)
                at = at[known[at] & known[at + 1]]
            columns = [c.combine_chunks() for c in tokens.counted(at, n).columns]
            if n > 1:
                return columns
            words = pa.table({"lang": columns[0], "f": columns[2]}).group_by("lang").aggregate([("f", "sum")])
            return [pa.concat_arrays([columns[0], words["lang"].combine_chunks()]),
                    pa.concat_arrays([columns[1], pa.nulls(len(words), pa.string())]),
                    pa.concat_arrays([columns[2], words["f_sum"].combine_chunks()])]

        return step

    return make


def _runs(bitmap):
    """The longest stretches of chunks in which every two neighbours are in the bitmap.

    Those of three words and more that begin among the chunk's own words; longer
    phrases stand nowhere else.
    """
    def make():
        seen = _bits(bitmap)

        def step(batch):
            tokens = Tokens(batch)
            pair = tokens.known(2, seen) & (tokens.left >= 2)
            pair[:-1] &= tokens.is_word[:-1] & tokens.is_word[1:]
            edge = np.diff(np.concatenate([[0], pair.astype(np.int8), [0]]))
            a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # tokens a to b
            good = (b - a >= 2) & tokens.own[a]
            a, b = a[good], b[good]
            before = np.concatenate([[0], np.cumsum(tokens.own)])
            return [batch.column(0).take(pa.array(tokens.row[a])), stretches(tokens.data, tokens.start[a], tokens.end[b]),
                    pa.array(before[b + 1] - before[a], pa.int32()), pa.array(tokens.times[tokens.row[a]], pa.int64())]

        return step

    return make


def _hash_phrases(n: int):
    def step(batch):
        count = batch.num_rows
        chunk = pa.record_batch([batch.column(0), batch.column(1), pa.array(np.zeros(count, np.int32)),
                                 pa.array(np.ones(count, np.int64))], names=["lang", "chunk", "own", "times"])
        return [(Tokens(chunk).hashes(n)[::n] % np.uint64(BITS)).astype(np.int64)]

    return lambda: step


def _bitmap(phrases: DataFrame, n: int) -> bytes:
    """Bitmap of the hashes of (lang, phrase), of BITS bits however many there are."""
    code = map_rows(phrases.select("lang", "phrase"), _hash_phrases(n), "code long", ROWS)
    page, bit = F.shiftright("code", PAGE.bit_length() - 1), F.col("code") % PAGE
    pages = code.groupBy(page.alias("page")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    whole = np.zeros(BITS // 8, np.uint8)
    for row in pages.toLocalIterator():
        start = row["page"] * PAGE // 8
        whole[start:start + PAGE // 8] = np.frombuffer(row["bits"], np.uint8)
    return whole.tobytes()


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Columns lang, phrase, size (words) and f of phrases found ``least`` times or more,
    and columns lang and n, the number of words of each language."""
    spark, window = docs.sparkSession, longest - 1
    rows = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       quoted(text_col).alias("text"))
    parsed = map_rows(rows, _parse(window), "lang string, chunk string, own int")
    dictionary = settle(parsed.groupBy("lang", "chunk", "own").agg(F.count(F.lit(1)).alias("times")))
    found, bitmap, total = [], None, None
    for n in range(1, longest + 1):
        if n == 3:  # every phrase from here on has only pairs of neighbours that were found
            runs = map_rows(dictionary, _runs(bitmap), "lang string, chunk string, own int, times long", ROWS)
            dictionary = settle(runs.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times")))
            bitmap = None
        part = map_rows(dictionary, _count(n, bitmap), "lang string, phrase string, f long", ROWS)
        level = settle(part.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(
            F.col("phrase").isNull() | (F.col("f") >= least)))
        if n == 1:
            total = level.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
            level = level.filter("phrase IS NOT NULL")
        found.append(level.select("lang", "phrase", F.lit(n).alias("size"), "f"))
        if level.isEmpty():
            break
        if n < longest:
            bitmap = spark.sparkContext.broadcast(_bitmap(level, n))
    return reduce(DataFrame.unionByName, found), total


# -- scoring -----------------------------------------------------------------------


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """Columns lang, rank, phrase, a, l, r, n and score: the best ``top`` phrases of each language."""
    counts, total = frequent_phrases(docs, text_col, lang_col, longest, least)
    phrases = counts.filter("size > 1").withColumnRenamed("f", "a")
    first, rest = F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - size)")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", first.alias("first"), rest.alias("rest"))
    scored = (
        cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(total, "lang")
    )
    # Products of two counts need more than 64 bits; their quotient is 1000 n / least at most.
    a, n, l, r = (f"cast({c} AS decimal(18,0))" for c in "anlr")
    score = F.expr(f"((1000 * {a}) * {n}) div ({l} * {r})")
    best = scored.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    longer = phrases.filter("size > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy(
        "lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (100 * F.col("most") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                         "cut.l", "cut.r", "n", "cut.score")
