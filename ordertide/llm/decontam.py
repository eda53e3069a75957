"""Benchmark decontamination: edit distance by random walks and bit sampling.

Texts and items become words (lower case, letters and digits); in scripts written
without spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) every character is a
word. A text holds an item if some stretch of its words is within ``(1 - similarity)``
of the item's length in word edits; an item of fewer than ``MIN_WORDS`` words must be
there without an edit. Finding the stretches takes three steps.

1. Windows of the size of the items start at every word. An edit spoils at most one
   word of an item, so a stretch that matches keeps all but the allowed number of any
   of its words. Taking the item's rarest words, windows without enough of one item's
   words close together are passed over; no match is lost.
2. The random walk of Chakraborty, Goldenberg and Koucky copies the symbol it
   stands on at every step and moves on where a coin, drawn per step and symbol,
   says so. It maps strings at small edit distance to strings at small Hamming
   distance. ``SAMPLES`` places of the walk are sampled as the key of a bucket; a
   window is a candidate for the items in its bucket. This is repeated with new
   coins and places until simulated edited copies of the items are found with
   ``recall``: the number of repetitions comes from ``TRIALS`` simulated copies in
   each class of lengths, as long items need more. A class that does not reach
   ``recall`` in ``MOST_ROUNDS``, or has items over ``LONGEST`` words, is not walked:
   all its windows of step 1 are candidates.
3. Every candidate is verified by the exact edit distance of the item to the best
   stretch around the window (bit-parallel, any length).

Items are processed in blocks of ``BLOCK`` bytes of text, one after the other, so that what
the driver holds and the tasks get is bounded however long the benchmark is; each block
scans the texts once, and with several blocks what each finds or leaves is stored.
Items without words match nothing; equal items are all reported. An item whose id is
null has no row in ``find_items``, but ``drop_contaminated`` drops what holds it.
Null and empty texts hold no item. Repeated rows each get their rows.
"""

import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import kept, map_rows, mix, quoted, type_of
from ordertide.sources.scratch import settle

SIMILARITY, RECALL, SAMPLES, MIN_WORDS = 0.8, 0.99, 2, 5
MOST_ROUNDS, TRIALS, RATIO, BLOCK = 64, 400, 1.25, 4 << 20
OFFSETS, LONGEST = 8, 1024  # simulated windows on either side of a copy's start; longest walk
SPACELESS = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u3096\u309d-\u309f"
             "\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uaa60-\uaa7f"
             "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
WORD, WITHOUT_SPACES = re.compile(r"\w+"), re.compile(f"[{SPACELESS}]")
MIXED = re.compile(f"[{SPACELESS}]|[^\\W{SPACELESS}]+")


def pattern_of(text: str) -> re.Pattern:
    return MIXED if not text.isascii() and WITHOUT_SPACES.search(text) else WORD


def words_of(text: str | None) -> list[str]:
    lowered = (text or "").lower()
    return pattern_of(lowered).findall(lowered)


class Codes(dict):
    """Numbers of the items' words from 1; every other word is 0."""

    def __missing__(self, word: str) -> int:
        return 0

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def edit_positions(item: list[int], text: list[int], most: int) -> list[tuple[int, int]]:
    """(end, distance) of all stretches of ``text`` within ``most`` edits of ``item``.

    Bit-parallel semi-global edit distance; Python's integers give any width.
    """
    masks: dict[int, int] = defaultdict(int)
    for k, symbol in enumerate(item):
        masks[symbol] |= 1 << k
    full, top = (1 << len(item)) - 1, 1 << len(item) - 1
    plus, minus, distance, found = full, 0, len(item), []
    for end, symbol in enumerate(text, 1):
        equal = masks.get(symbol, 0)
        vertical = equal | minus
        level = ((equal & plus) + plus ^ plus) | equal
        up, down = minus | ~(level | plus) & full, plus & level
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if distance <= most:
            found.append((end, distance))
    return found


def best_stretch(item: list[int], text: list[int], most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the nearest stretch; ties go to the first, then the shortest."""
    ends = edit_positions(item, text, most)
    if not ends:
        return None
    end, distance = min(ends, key=lambda e: (e[1], e[0]))
    # Backwards from that end the same search gives where the stretch starts.
    back = edit_positions(item[::-1], text[max(0, end - len(item) - most):end][::-1], distance)
    return distance, end - min(e for e, d in back if d == distance), end


class Walks:
    """Random walks and sampled places, the same in every process.

    ``steps`` is the shortest item of a class of lengths: places are sampled among
    that many steps, within which no walk has left its item.
    """

    def __init__(self, symbols: int, steps: int, rounds: int):
        self.steps, self.rounds = steps, rounds
        blocks = range(0, steps, 64)  # 64 steps take their coins from one number
        known = np.arange(1, symbols + 1, dtype=np.uint64)
        self.coins = [np.stack([mix(mix(known + np.uint64(b)) + np.uint64(r + 1 << 32))
                                for r in range(rounds)]) for b in blocks]
        self.places = [np.random.default_rng([20240229, r]).integers(0, steps, SAMPLES)
                       for r in range(rounds)]

    def keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bucket of each start (rows) in each round: shape (starts, rounds)."""
        size = min(2048, max(16, (16 << 20) // (self.steps * self.rounds)))
        parts = [self._keys(codes, starts[a:a + size]) for a in range(0, len(starts), size)]
        return np.concatenate(parts) if parts else np.zeros((0, self.rounds), np.uint64)

    def _keys(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        count, which = len(starts), np.arange(self.rounds)[:, None]
        path = np.empty((self.steps, self.rounds, count), np.int32)
        at = np.broadcast_to(starts, (self.rounds, count)).copy()
        for step in range(self.steps):
            symbol = path[step] = codes.take(at, mode="clip")
            coin = self.coins[step >> 6][which, symbol] >> np.uint64(step & 63)
            at += (coin & np.uint64(1)).astype(np.int64)
        out = np.empty((count, self.rounds), np.uint64)
        for r, places in enumerate(self.places):
            key = np.full(count, r + 1, np.uint64)
            for place in places:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + path[place, r].astype(np.uint64))
            out[:, r] = key
        return out


class Index:
    """A block of items, ready to search texts.

    ``rounds`` has a number per class of lengths, 0 for one that is not walked; None:
    found by simulation.
    """

    def __init__(self, items, similarity: float = SIMILARITY, recall: float = RECALL,
                 rounds: tuple[int, ...] | None = None):
        known = [(i, words_of(t)) for i, t in items]
        known = [(i, w) for i, w in known if w]
        self.ids = [i for i, _ in known]
        vocabulary = sorted({w for _, words in known for w in words})
        self.codes = Codes({w: n for n, w in enumerate(vocabulary, 1)})
        self.items = [self.codes.of(w) for _, w in known]
        self.most = [int((1 - similarity) * len(w) + 1e-9) if len(w) >= MIN_WORDS else 0
                     for w in self.items]
        self.rounds = rounds or ()
        if not self.items:
            return
        self._rare_words(len(vocabulary) + 1)
        self._classes()
        if rounds is None:
            self.rounds = tuple(self._calibrate(c, recall) for c in range(len(self.classes)))
        self.walks, self.buckets, self.known = [], [], []
        for c, members in enumerate(self.classes):
            walks = self._walks(c, self.rounds[c]) if self.rounds[c] else None
            buckets: dict[int, list[int]] = defaultdict(list)
            for k, own in zip(members, self._item_keys(walks, members) if walks else ()):
                for key in set(own.tolist()):
                    buckets[key].append(k)
            self.walks.append(walks)
            self.buckets.append(buckets)
            self.known.append(np.array(sorted(buckets), np.uint64))

    def _rare_words(self, symbols: int) -> None:
        """Per item its rarest words: all that few items have, and enough to outlast the edits.

        ``lists`` holds, per word, the items that count it; ``needed`` of its counted
        words are in any stretch that matches an item, ``reach`` words long at most.
        """
        often = Counter(c for item in self.items for c in set(item.tolist()))
        few = max(1, len(self.items) // 50)
        entries, self.needed = [], np.zeros(len(self.items), np.int64)
        for k, item in enumerate(self.items):
            ordered = sorted(item.tolist(), key=lambda c: (often[c], c))
            count = max(sum(often[c] <= few for c in ordered), self.most[k] + 1)
            counted = set(ordered[:count])
            self.needed[k] = sum(c in counted for c in ordered) - self.most[k]
            entries += [(c, k) for c in counted]
        entries.sort()
        self.lists = np.array([k for _, k in entries], np.int64)
        codes = np.array([c for c, _ in entries])
        self.list_start = np.searchsorted(codes, np.arange(symbols + 1))
        self.reach = np.array([len(i) + m for i, m in zip(self.items, self.most)])

    def _classes(self) -> None:
        """Items by length, each class up to ``RATIO`` times its shortest."""
        self.classes: list[list[int]] = []
        for k in sorted(range(len(self.items)), key=lambda k: len(self.items[k])):
            last = self.classes[-1] if self.classes else None
            if last and len(self.items[k]) <= RATIO * len(self.items[last[0]]):
                last.append(k)
            else:
                self.classes.append([k])
        self.class_of = np.zeros(len(self.items), np.int64)
        for c, members in enumerate(self.classes):
            self.class_of[members] = c

    def _walks(self, c: int, rounds: int) -> Walks:
        return Walks(len(self.codes) + 1, len(self.items[self.classes[c][0]]), rounds)

    def _item_keys(self, walks: Walks, which) -> np.ndarray:
        tail = np.zeros(walks.steps, np.int32)  # after an item stands a word no item has
        joined, starts, at = [], [], 0
        for k in which:
            joined += [self.items[k], tail]
            starts.append(at)
            at += len(self.items[k]) + len(tail)
        return walks.keys(np.concatenate(joined), np.array(starts))

    def _calibrate(self, c: int, recall: float) -> int:
        """As many rounds as find ``recall`` of simulated copies with all edits allowed; 0: none do."""
        members, pick = self.classes[c], random.Random(7)
        if len(self.items[members[-1]]) > LONGEST:
            return 0
        which = [pick.randrange(len(members)) for _ in range(TRIALS)]
        gap = [0] * (2 * int(self.reach[members].max()))
        codes, true = list(gap), []
        for m in which:
            true.append(len(codes))
            codes += self._edited(self.items[members[m]].tolist(), self.most[members[m]], pick) + gap
        codes, true = np.array(codes, np.int32), np.array(true)
        item, low, high = self.intervals(codes)
        mine = self.class_of[item] == c
        starts = self._starts(low[mine], high[mine], len(codes))
        trial = np.searchsorted(true - len(gap) // 2, starts, side="right") - 1
        near = (trial >= 0) & (np.abs(starts - true[trial]) <= OFFSETS)
        starts, trial = starts[near], trial[near]
        rounds = min(8, MOST_ROUNDS)
        while True:
            walks = self._walks(c, rounds)
            own = self._item_keys(walks, members)[which]
            hit = np.zeros((TRIALS, rounds), bool)
            np.logical_or.at(hit, trial, walks.keys(codes, starts) == own[trial])
            found = np.logical_or.accumulate(hit, axis=1).mean(axis=0)
            if found[-1] >= recall:
                return int((found >= recall).argmax()) + 1
            if rounds == MOST_ROUNDS:
                return 0
            rounds = min(2 * rounds, MOST_ROUNDS)

    @staticmethod
    def _edited(item: list[int], edits: int, pick: random.Random) -> list[int]:
        copy = list(item)
        for _ in range(edits):
            place, kind = pick.randrange(len(copy)), pick.randrange(3)
            if kind == 0:
                copy[place] = 0
            elif kind == 1:
                copy.insert(place, 0)
            else:
                del copy[place]
        return copy

    # -- search ------------------------------------------------------------

    def intervals(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, first, last): stretches that may match the item start there, no others."""
        first, count = self.list_start[codes], np.diff(self.list_start)[codes]
        place = np.repeat(np.arange(len(codes)), count)
        inner = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
        item = self.lists[np.repeat(first, count) + inner]
        order = np.argsort(item, kind="stable")
        place, item = place[order], item[order]
        last = np.arange(len(place)) + self.needed[item] - 1
        inside = np.flatnonzero(last < len(place))
        last = last[inside]
        near = (item[last] == item[inside]) & (place[last] - place[inside] < self.reach[item[inside]])
        inside, last = inside[near], last[near]
        item = item[inside]
        return item, np.maximum(place[last] + 1 - self.reach[item], 0), place[inside]

    @staticmethod
    def _starts(low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
        """All places in the intervals."""
        change = np.zeros(size + 1, np.int64)
        np.add.at(change, low, 1)
        np.add.at(change, high + 1, -1)
        return np.flatnonzero(np.cumsum(change[:-1]) > 0)

    def candidates(self, codes: np.ndarray, bounds: np.ndarray) -> set:
        """(start, item) pairs that share a bucket, or may match where a class is not walked."""
        item, low, high = self.intervals(codes)
        class_of, found = self.class_of[item], set()
        for c in np.unique(class_of).tolist():
            mine, walks, known = class_of == c, self.walks[c], self.known[c]
            if walks is None:
                # The regions around an interval's ends cover it.
                text = bounds[np.searchsorted(bounds, high[mine], side="right") - 1]
                for starts in (np.maximum(low[mine], text), high[mine]):
                    found.update(zip(starts.tolist(), item[mine].tolist()))
                continue
            padded = np.concatenate([codes, np.zeros(walks.steps, np.int32)])
            starts = self._starts(low[mine], high[mine], len(codes))
            for a in range(0, len(starts), 2048):
                part = starts[a:a + 2048]
                keys = walks.keys(padded, part)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                for s, r in zip(*np.nonzero(known[at] == keys)):
                    found.update((int(part[s]), k) for k in self.buckets[c][int(keys[s, r])])
        return found

    def search(self, texts: list[str | None]):
        """(text, item, distance, first word, end word) of every item that a text holds."""
        if not self.items:
            return
        bounds, flat = [0], []
        for text in texts:
            flat.append(self.codes.of(words_of(text)))
            bounds.append(bounds[-1] + len(flat[-1]))
        codes = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        pairs = self.candidates(codes, np.array(bounds))
        owner = np.searchsorted(bounds, [s for s, _ in pairs], side="right") - 1
        per_pair = defaultdict(list)
        for (start, k), n in zip(pairs, owner.tolist()):
            per_pair[n, k].append(start)
        for (n, k), places in sorted(per_pair.items()):
            item, most, best = self.items[k].tolist(), self.most[k], None
            for a, b in self._regions(sorted(places), len(item), most):
                a, b = max(a, bounds[n]), min(b, bounds[n + 1])
                got = best_stretch(item, codes[a:b].tolist(), most)
                if got and (best is None or got[0] < best[0]):
                    best = got[0], a - bounds[n] + got[1], a - bounds[n] + got[2]
            if best:
                yield (n, self.ids[k], *best)

    @staticmethod
    def _regions(starts: list[int], size: int, most: int):
        """Stretches around the starts; those that overlap are one."""
        regions: list[list[int]] = []
        for s in starts:
            a, b = s - most, s + size + 2 * most
            if regions and a <= regions[-1][1]:
                regions[-1][1] = b
            else:
                regions.append([a, b])
        return regions


# -- on tables --------------------------------------------------------------------


def blocks(benchmark: DataFrame, id_col: str, text_col: str, null_ids: bool = False) -> Iterator[tuple[tuple, bool]]:
    """The items in parts of at most about ``BLOCK`` bytes, one at a time, and whether there are several."""
    rows = benchmark.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).filter(
        "text IS NOT NULL").distinct()
    if not null_ids:
        rows = rows.filter("id IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = total // BLOCK + 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    for k in range(count):
        items = ((r["id"], r["text"]) for r in rows.filter(part == k).toLocalIterator())
        yield tuple(sorted(items, key=lambda item: (item[0] is None, item))), count > 1


def _spans(text: str, first: int, end: int) -> tuple[int, int]:
    """Code points of the stretch of words; lower case may be longer, so words are counted anew."""
    found = [m.span() for m in pattern_of(text).finditer(text)]
    if len(found) != len(words_of(text)):
        return -1, -1
    return found[first][0], found[end - 1][1]


@kept
def _index(items: tuple, similarity: float, rounds: tuple[int, ...]) -> Index:
    return Index(items, similarity, rounds=rounds)


def _find(items: tuple, similarity: float, recall: float):
    rounds = Index(items, similarity, recall).rounds  # simulated once, on the driver

    def make():
        index, lengths = _index(items, similarity, rounds), {i: len(words_of(t)) for i, t in items}

        def step(batch):
            texts = batch.column(1).to_pylist()
            rows = [(n, i, d, lengths[i], *_spans(texts[n], a, b))
                    for n, i, d, a, b in index.search(texts)]
            n, *rest = (list(c) for c in zip(*rows)) if rows else [[]] * 6
            return [batch.column(0).take(pa.array(n, pa.int64())), *rest]

        return step

    return make


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """A row per text and item it holds.

    Columns ``id_col``, ``item_id``, edits, n_words (of the item), start and end (code
    points of the best stretch; -1 if lower case splits the text's words otherwise).
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    item_kind = benchmark.schema[item_id].dataType.simpleString()
    schema = (f"id {type_of(rows, 'id')}, item {item_kind}, edits long, n_words long, "
              "start long, end long")
    found = None
    for items, several in blocks(benchmark, item_id, item_text):
        part = map_rows(rows, _find(items, similarity, recall), schema)
        part = settle(part) if several else part  # the driver holds one block at a time
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item", item_id)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text",
                      similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """All columns of the rows whose text holds no item."""
    at, schema = docs.columns.index(text_col), docs.schema.toDDL()
    for items, several in blocks(benchmark, item_id, item_text, null_ids=True):
        rounds = Index(items, similarity, recall).rounds

        def make(items=items, rounds=rounds):
            index = _index(items, similarity, rounds)

            def step(batch):
                held = {n for n, *_ in index.search(batch.column(at).to_pylist())}
                clean = pa.array([n not in held for n in range(batch.num_rows)], pa.bool_())
                return batch.filter(clean).columns

            return step

        docs = map_rows(docs, make, schema)
        docs = settle(docs) if several else docs
    return docs
