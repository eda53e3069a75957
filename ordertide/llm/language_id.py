"""Language identification by cross-parsing entropy.

Per language a suffix automaton of a bounded labelled sample is built. A text is
parsed against it greedily: each phrase is the longest match of what follows
anywhere in the sample (at least one symbol). Phrases times the bits that name a
place in the sample, per symbol of the text, estimate the cross entropy; the
language with the least wins, ties go to the smaller name.

Symbols are lower-case letters; every run of other characters is one space.
Phrases end at multiples of ``SEGMENT`` symbols, so that the segments of all texts
of a batch step through the automata side by side, whatever their length.

A null text, one without letters, or any text when nothing was learned gets
``und`` and score 0. The score is the runner-up's share of the two best entropies:
0.5 for a tie, near 1 for a clear win, 1 for the only language. Rows with a null
language teach nothing. Repeated rows each get their row.

The sample: per language the ``SAMPLE_ROWS`` ids with the smallest hash, one row of each
(that with the smallest sample, if rows share an id). A text of up to ``SAMPLE_CHARS``
characters is taken whole; of a longer one ``PIECES`` pieces are taken, one from a hashed
place in each equal part, so that nothing at its start or end counts more than the rest.
Samples are joined until they have ``MODEL_CHARS`` symbols. Only learning is bounded;
every text is parsed whole.
"""

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordertide.llm.common import held_out, kept, map_rows, quoted, type_of

SAMPLE_ROWS, SAMPLE_CHARS, PIECES, MODEL_CHARS, SEGMENT = 64, 2000, 8, 20_000, 2048
UNKNOWN = "und"
SPACE = 0


# -- symbols -----------------------------------------------------------------


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    lowered = text.lower()
    return np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)


def normalized(text: str) -> str:
    """Lower-case words with one space between them."""
    codes = code_points(text)
    out = np.where(_letters()[codes], codes, ord(" "))
    return " ".join(out.tobytes().decode("utf-32-le").split())


def alphabet_table(letters: str) -> np.ndarray:
    """Symbol of each code point: 0 space, 1.. letters of the samples, last all other letters."""
    table = np.where(_letters(), len(letters) + 1, SPACE).astype(np.int32)
    for k, c in enumerate(letters):
        table[ord(c)] = k + 1
    return table


# -- automaton ------------------------------------------------------------------


def suffix_automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the states that recognise all substrings; state 0 is the start."""
    moves, link, length, last = [{}], [-1], [0], 0
    for s in symbols:
        state = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = state
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return moves


class Parser:
    """Automata of all languages as one table: (state, symbol) -> (next state, new phrase?).

    An entry is ``2 * row + starts``: the row (state times width) to go to, and
    whether this symbol starts a phrase. A symbol that the sample lacks is a
    phrase of its own and leads back to the start.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        texts = [normalized(samples[name])[:MODEL_CHARS] for name in self.languages]
        letters = "".join(sorted(set("".join(texts)) - {" "}))
        self.table = alphabet_table(letters)
        self.width = len(letters) + 2
        tables, self.starts, rows = [], [], 0
        for text in texts:
            symbols = self.table[code_points(text)].tolist()
            moves = suffix_automaton(symbols)
            dense = np.full((len(moves), self.width), -1, np.int64)
            for state, to in enumerate(moves):
                if to:
                    dense[state, list(to)] = list(to.values())
            first = np.maximum(dense[0], 0)
            new = dense < 0
            new[0] = True
            dense = np.where(dense < 0, first, dense)
            tables.append((2 * (dense + rows) * self.width + new).ravel())
            self.starts.append(rows * self.width)
            rows += len(moves)
        kind = np.int32 if 2 * rows * self.width < 1 << 31 else np.int64
        self.flat = np.concatenate(tables).astype(kind) if tables else np.zeros(0, kind)
        self.starts = np.array(self.starts, kind)
        self.bits = np.array([math.log2(len(t) + 2) for t in texts])

    def symbols(self, text: str) -> np.ndarray:
        """Symbols with runs of non-letters as one space, none at the ends."""
        s = self.table[code_points(text)]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != SPACE) | (s[:-1] != SPACE)
        s = s[keep]
        if len(s) and s[0] == SPACE:
            s = s[1:]
        return s[:-1] if len(s) and s[-1] == SPACE else s

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        owner, begin, size, at = [], [], [], 0
        for n, s in enumerate(texts):
            for start in range(0, len(s), SEGMENT):
                owner.append(n)
                begin.append(at + start)
                size.append(min(SEGMENT, len(s) - start))
            at += len(s)
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        if not owner or not self.languages:
            return total
        order = np.argsort(-np.array(size), kind="stable")
        owner, begin, size = (np.array(a)[order] for a in (owner, begin, size))
        codes = np.concatenate(texts).astype(self.flat.dtype)
        # Segments with at least t+1 symbols are the first alive[t] ones.
        alive = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")
        state = np.repeat(self.starts[:, None], len(size), axis=1)
        count = np.zeros(state.shape, np.int32)
        for t, n in enumerate(alive):
            entry = self.flat.take(state[:, :n] + codes[begin[:n] + t])
            count[:, :n] += entry & 1
            state[:, :n] = entry >> 1
        np.add.at(total, owner, count.T)
        return total

    def detect(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [self.symbols(t or "") for t in texts]
        entropy = self.phrases(coded) * self.bits
        names, scores = [], []
        for s, row in zip(coded, entropy):
            if not len(s) or not len(row):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(row.argmin())
            names.append(self.languages[best])
            rest = np.delete(row, best)
            scores.append(float(rest.min() / (rest.min() + row[best])) if len(rest) else 1.0)
        return names, scores


@kept
def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(samples))


# -- on tables --------------------------------------------------------------------


def sampled(text: Column, rank: Column) -> Column:
    """A short text, or pieces of a long one from hashed places all over it."""
    size, each = F.length(text), SAMPLE_CHARS // PIECES
    room = (size / PIECES).cast("long")  # of each part
    pieces = [
        F.substring(text, (k * room + F.pmod(F.xxhash64(rank, F.lit(k)), room - each + 1) + 1).cast("int"),
                    F.lit(each)) for k in range(PIECES)]
    return F.when(size <= SAMPLE_CHARS, text).otherwise(F.concat_ws(" ", *pieces))


def sample_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame | None:
    """Columns lang, rank and part: SAMPLE_ROWS rows of each language at most; None if there is none.

    The smallest hashes are found on ids alone; Spark cuts each task's rows to the
    first of each language before it shuffles them. Then only the rows below the
    largest of them are sampled; rows of one id become one before they meet.
    """
    lang, rank = quoted(lang_col).cast("string"), F.xxhash64(quoted(id_col).cast("string"))
    rows = docs.filter(lang.isNotNull() & quoted(text_col).isNotNull() & ~held_out(id_col))
    keys = rows.select(lang.alias("lang"), rank.alias("rank")).distinct()
    best = Window.partitionBy("lang").orderBy("rank")
    least = keys.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= SAMPLE_ROWS)
    bounds = least.groupBy("lang").agg(F.max("rank").alias("rank")).collect()
    if not bounds:
        return None
    chosen = reduce(Column.__or__, [(lang == b["lang"]) & (rank <= b["rank"]) for b in bounds])
    found = rows.filter(chosen).select(
        lang.alias("lang"), rank.alias("rank"), sampled(quoted(text_col), rank).alias("part"))
    return found.groupBy("lang", "rank").agg(F.min("part").alias("part"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> dict[str, str]:
    """The sample text of each language, from rows that are not held out."""
    rows = sample_rows(docs, id_col, text_col, lang_col)
    samples: dict[str, str] = {}
    for row in sorted(rows.collect() if rows else [], key=lambda r: (r["lang"], r["rank"])):
        if len(samples.get(row["lang"], "")) < 2 * MODEL_CHARS:
            samples[row["lang"]] = samples.get(row["lang"], "") + " " + row["part"]
    return {name: text for name, text in samples.items() if normalized(text)}


def _detect(samples):
    def make():
        parser = _parser(samples)

        def step(batch):
            names, scores = parser.detect(batch.column(1).to_pylist())
            return [batch.column(0), names, scores]

        return step

    return make


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Columns ``id_col``, lang_pred and score of each row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    found = map_rows(rows, _detect(tuple(sorted(samples.items()))),
                     f"id {type_of(rows, 'id')}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, samples: dict[str, str], text_col: str = "text") -> DataFrame:
    """All columns of the rows whose language is known."""
    at, known_samples = docs.columns.index(text_col), tuple(sorted(samples.items()))

    def make():
        parser = _parser(known_samples)

        def step(batch):
            names, _ = parser.detect(batch.column(at).to_pylist())
            known = pa.array([n != UNKNOWN for n in names], pa.bool_())
            return batch.filter(known).columns

        return step

    return map_rows(docs, make, docs.schema.toDDL())
