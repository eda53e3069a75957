"""License scans with a generalised suffix automaton of licence words.

One automaton recognises every run of words of all templates: passages of licences
and short phrases that name one. A text streams through it word by word; after each word
the automaton knows the longest run that ends there and stands in some template (the
matching statistics). A run that the next word does not prolong and that has ``SEED_WORDS``
or more is an anchor, with all the places that its state has in templates.

Anchors are chained per passage: an anchor prolongs a chain if it follows within ``GAP``
words both in the text and in the passage (words that two anchors share count once); of
several such chains it takes the one that covers most, else it begins one. A chain that
covers ``COVER`` of its passage or more is a span with the passage's label. Words that
were edited, added or dropped end an anchor and lie in a gap of the chain.

A phrase is found wherever its words stand consecutively, exactly: it is there when the
automaton's run ends with it. All such places count, overlapping ones too.

A-Z are lower-cased and words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, letters and
everything beyond ASCII. A null or empty text has no words and no spans. Repeated rows
each get their row; other columns are not read. The score is the largest share of a
template that one chain covers, 1 where a phrase is found, 0 where there is no anchor.
Work is one step per word, whatever the length of the text; of it only open chains (at
most a few per word of the last ``GAP``) and found spans are kept.
"""

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import map_rows, quoted, type_of
from ordertide.llm.license_texts import PASSAGES, PHRASES

SEED_WORDS, GAP, COVER = 4, 8, 0.5

_UPPER = bytes(range(65, 91))
_WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_PLAIN = bytes(c if c in _WORD_BYTES else 0x20 for c in _LOWER)


def words_of(text: str | None) -> list[bytes]:
    # Upper bytes of UTF-8 are words all through, so bytes split as code points would.
    return (text or "").encode("utf-8").translate(_PLAIN).split()


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[bytes]]):
        self.symbol: dict[bytes, int] = {}
        self.moves, self.link, self.size = [{}], [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]  # (sequence, end) of the longest run
        for number, words in enumerate(sequences):
            state = 0
            for end, word in enumerate(words, 1):
                state = self._extended(state, self.symbol.setdefault(word, len(self.symbol)))
                self.places[state].append((number, end))
        # Places of a run are those of all longer ones that end with it.
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.places[self.link[state]] += self.places[state]
        self.places[0] = []

    def _state(self, size: int, moves: dict[int, int], link: int) -> int:
        self.moves.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.places.append([])
        return len(self.size) - 1

    def _split(self, above: int, symbol: int, below: int) -> int:
        """The state of the run one longer than ``above``'s longest, cut out of ``below`` if need be."""
        if self.size[below] == self.size[above] + 1:
            return below
        copy = self._state(self.size[above] + 1, dict(self.moves[below]), self.link[below])
        self.link[below] = copy
        while above >= 0 and self.moves[above].get(symbol) == below:
            self.moves[above][symbol] = copy
            above = self.link[above]
        return copy

    def _extended(self, last: int, symbol: int) -> int:
        known = self.moves[last].get(symbol)
        if known is not None:  # another sequence has this run
            return self._split(last, symbol, known)
        state = self._state(self.size[last] + 1, {}, 0)
        while last >= 0 and symbol not in self.moves[last]:
            self.moves[last][symbol] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, symbol, self.moves[last][symbol])
        return state


class Scanner:
    """The automaton of a set of passages and phrases, and the chaining of its matches."""

    def __init__(self, passages: dict[str, list[str]], phrases: dict[str, str]):
        texts = [(label, text) for label, several in sorted(passages.items()) for text in several]
        self.labels = [label for label, _ in texts]
        sequences = [words_of(text) for _, text in texts]
        self.lengths = [len(s) for s in sequences]
        named = [words_of(p) for p in phrases]
        self.phrase_labels = list(phrases.values())
        automaton = self.automaton = Automaton(sequences + named)
        self.symbol, self.moves = automaton.symbol.get, automaton.moves
        self.link, self.size = automaton.link, automaton.size
        # Of each state, the phrases that its longest run ends with.
        self.ending: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(named):
            home = 0
            for word in words:
                home = self.moves[home][self.symbol(word)]
            for state in range(1, len(self.size)):
                above = state
                while above > 0 and above != home:
                    above = self.link[above]
                if above == home:
                    self.ending.setdefault(state, []).append((k, len(words)))
        # Where a state's runs end in passages; phrases are no passages.
        self.places = [[(t, end) for t, end in places if t < len(texts)] for places in automaton.places]

    def matches(self, words: list[bytes]):
        """(end, state, length) after each word that some template has; the matching statistics."""
        moves, link, size, symbol = self.moves, self.link, self.size, self.symbol
        state = length = 0
        for end, word in enumerate(words, 1):
            s = symbol(word)
            if s is None:
                if length:
                    state = length = 0
                    yield end, 0, 0
                continue
            while state and s not in moves[state]:
                state = link[state]
                length = size[state]
            to = moves[state].get(s)
            state, length = (to, length + 1) if to is not None else (0, 0)
            yield end, state, length

    def scan(self, words: list[bytes]):
        """Base places (start, phrase) and chains [passage, start, end, covered words]."""
        base, chains, open_chains, ending = [], [], [], self.ending
        before = run = at = 0
        for end, state, length in self.matches(words):
            if length <= run and run >= SEED_WORDS:  # the run before this word was prolonged no further
                open_chains = self._chained(open_chains, chains, at - run, at, before)
            before, run, at = state, length, end
            if state in ending:
                base += [(end - size, k) for k, size in ending[state] if size <= length]
        if run >= SEED_WORDS:
            open_chains = self._chained(open_chains, chains, at - run, at, before)
        chains += open_chains
        return sorted(base), [(t, start, end, covered) for t, start, end, _, covered in chains]

    def _chained(self, open_chains, done, start: int, end: int, state: int):
        """The open chains after an anchor: [passage, start, end, end in the passage, covered]."""
        done += [c for c in open_chains if start - c[2] > GAP]
        going = [c for c in open_chains if start - c[2] <= GAP]
        for passage in sorted({t for t, _ in self.places[state]}):
            best = None
            for c in going:
                new = end - max(start, c[2])
                if c[0] != passage or new <= 0:
                    continue
                ends = [e for t, e in self.places[state] if t == passage and 0 <= e - new - c[3] <= GAP]
                if ends and (best is None or c[4] > best[0][4]):
                    best = c, min(ends), new
            if best is None:
                first = min(e for t, e in self.places[state] if t == passage)
                going.append([passage, start, end, first, end - start])
            else:
                chain, place, new = best
                chain[2:] = [end, place, chain[4] + new]
        return going

    def report(self, text: str | None):
        """n_words, base places [(start, label)], spans [(label, start, end, covered, share)], score."""
        words = words_of(text)
        base, chains = self.scan(words)
        spans, best = [], 1.0 if base else 0.0
        for passage, start, end, covered in chains:
            share = covered / self.lengths[passage]
            best = max(best, share)
            if share >= COVER:
                spans.append((self.labels[passage], start, end, covered, share))
        return (len(words), [(start, self.phrase_labels[k]) for start, k in base],
                sorted(spans, key=lambda s: (s[1], s[2], s[0])), best)


@lru_cache(maxsize=2)
def _scanner(passages: tuple, phrases: tuple) -> Scanner:
    return Scanner({label: list(texts) for label, texts in passages}, dict(phrases))


def _scan(passages: tuple, phrases: tuple):
    def make():
        scanner = _scanner(passages, phrases)

        def step(batch):
            found = [scanner.report(t) for t in batch.column(1).to_pylist()]
            return [batch.column(0), *([*column] for column in zip(*found))]

        return lambda batch: step(batch) if batch.num_rows else [batch.column(0), [], [], [], []]

    return make


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  passages: dict[str, list[str]] = PASSAGES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Columns ``id_col``, n_words, base, spans and score of each row.

    base: the places of phrases (start word, label); spans: covered stretches of passages
    (label, start word, end word exclusive, covered words, share of the passage), by start.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    fixed = tuple((k, tuple(v)) for k, v in sorted(passages.items())), tuple(phrases.items())
    found = map_rows(
        rows, _scan(*fixed),
        f"id {type_of(rows, 'id')}, n_words long, base array<struct<start: long, label: string>>, "
        "spans array<struct<label: string, start: long, end: long, covered: long, share: double>>, "
        "score double")
    return found.withColumnRenamed("id", id_col)


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per text: number and ends of base places, base labels, all labels, score."""
    start = F.col("base.start")
    base = F.array_distinct(F.col("base.label"))
    every = F.array_union(base, F.col("spans.label"))
    return found.select(
        quoted(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"), "score")
