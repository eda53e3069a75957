"""Sampled SentencePiece segmentations, and lossless decoding.

Every way to cut a text into pieces of the vocabulary is a path through a lattice.
A path has the product of its pieces' weights; forward filtering sums them over
all prefixes and backward sampling walks from the end, choosing each piece by its
share of the sum. That draws a segmentation from the exact distribution. The
random numbers come from the row's key, the place of the word and the step, so a
row gives the same pieces wherever and however often it is encoded.

A lattice falls apart wherever no piece of the vocabulary can cross: before a
space mark that follows another character, and beside characters that are in no
longer piece. The parts (mostly words) of a batch are filtered once per distinct
part and sampled side by side. Characters without a piece become their bytes;
so does a space mark that stands in the text itself, hence decoding gives the
text back exactly, and every row says whether it did.

Weights: a piece of rank r (the order of merges, 0 first) has (1 + r) ** -theta.
Large theta favours frequent, longer pieces; the segmentation gets near to the
usual one. Null and empty texts have no pieces. Repeated rows (same key and text)
get the same pieces; texts with a null key are seeded alike.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import kept, map_rows, mix, quoted, type_of

THETA = 1.0
MARK, RAW_MARK = "▁", "\udc00"  # the space mark; stands for one found in a text
STEP, PLACE = 0x9E3779B97F4A7C15, np.uint64(0xD1B54A32D192ED03)
BASE = np.uint64(0x100000001B3)
FEW = 16  # texts whose pieces are Python objects at a time


class Vocabulary:
    """Pieces with their weights, and where lattices fall apart."""

    def __init__(self, path: str, theta: float = THETA):
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size, self.byte_ids, normal = sp.vocab_size(), {}, []
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        self.pieces = {sp.id_to_piece(i): (i, -theta * np.log1p(rank))
                       for rank, i in enumerate(normal)}
        self.fallback = -theta * np.log1p(size)
        self.longest = max(map(len, self.pieces), default=1)
        joined = [p for p in self.pieces if len(p) > 1]
        self.inside = set("".join(joined)) | {c for c in self.pieces if len(c) == 1 and c == MARK}
        crosses = any(re.search(f"[^{MARK}]{MARK}", p) for p in joined)
        letters = "".join(map(re.escape, sorted(self.inside - {MARK})))
        run = f"[{letters}]+" if letters else "(?!)"
        self.parts = re.compile(
            f"[{letters}{MARK}]+|[^{letters}{MARK}]" if crosses
            else f"{MARK}*{run}|{MARK}+|[^{letters}{MARK}]", re.DOTALL)
        self._fill(list(self.pieces))

    def _fill(self, pieces: list[str]) -> None:
        """A hash table of the pieces; slot 0 is for what is no piece."""
        self.lengths = set(map(len, pieces))
        bits = max(4, (8 * len(pieces)).bit_length())
        self.shift, size = np.uint64(64 - bits), (1 << bits) + len(pieces) + 2
        self.known = np.zeros(size, np.uint64)
        self.ids, self.weights = np.zeros(size, np.int64), np.full(size, -np.inf)
        for p in pieces:
            h = _hash(codes_of([p]))[0]
            at = 1 + int(h >> self.shift)
            while self.known[at]:
                at += 1
            self.known[at] = h
            self.ids[at], self.weights[at] = self.pieces[p]

    def slots(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Where the piece of each hash is in the table, 0 if there is none."""
        if length not in self.lengths:
            return np.zeros(hashes.shape, np.int64)
        at = (hashes >> self.shift).astype(np.int64) + 1
        found = self.known[at]
        odd = np.nonzero((found != hashes) & (found != 0))
        at[found == 0] = 0
        while len(odd[0]):
            at[odd] += 1
            found = self.known[at[odd]]
            free = tuple(o[found == 0] for o in odd)
            at[free] = 0
            go = (found != hashes[odd]) & (found != 0)
            odd = tuple(o[go] for o in odd)
        return at

    def split(self, text: str) -> list[str]:
        """The independent parts of a text, space marks in place."""
        if MARK in text:
            text = text.replace(MARK, RAW_MARK)
        return self.parts.findall(MARK + text.replace(" ", MARK)) if text else []


def codes_of(parts: list[str]) -> np.ndarray:
    """Code points of equally long parts, one row each."""
    flat = "".join(parts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, np.uint32).reshape(len(parts), -1)


def _hash(codes: np.ndarray) -> np.ndarray:
    found = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        found = found * BASE + mix(codes[:, k].astype(np.uint64) + np.uint64(1))
    return found


class Growing:
    """An array that is appended to, with room for half as much again.

    Room is left as it comes and not written to, so it takes no memory until it is used.
    """

    def __init__(self, kind):
        self.data, self.size = np.empty(1 << 16, kind), 0

    def add(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.data):
            kept, self.data = self.data[:self.size], np.empty(size + size // 2, self.data.dtype)
            self.data[:self.size] = kept
        self.data[self.size:size] = values
        self.size = size


class Lattices(dict):
    """Filtered lattices of the parts met so far; as a dict, the number of each part.

    Node e of a part stands for its first e characters. ``first`` is the first edge
    that ends at a node; ``cum`` the share of the node's edges up to this one, 1 at
    the last. Beyond ``bound`` nodes a new batch starts afresh, so memory is bounded.
    """

    def __init__(self, vocabulary: Vocabulary, bound: int = 300_000):
        super().__init__()
        self.vocabulary, self.bound = vocabulary, bound
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.size, self.end, self.first = (Growing(np.int64) for _ in range(3))
        self.cum, self.back, self.ids = Growing(np.float64), Growing(np.int16), Growing(np.int32)

    def __missing__(self, part: str) -> int:
        number = self[part] = len(self)
        self.new.append(part)
        return number

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all parts, filtered if they are new, and how many each text has."""
        if self.first.size > self.bound:
            self.restart()
        found = [self._numbers_of(t or "") for t in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self._filter_new()
        return np.concatenate([np.zeros(0, np.int64), *found]), sizes

    def _numbers_of(self, text: str) -> np.ndarray:
        """The numbers of a text's parts; the parts themselves are not kept."""
        parts = self.vocabulary.split(text)
        return np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))

    def _filter_new(self) -> None:
        parts, self.new = self.new, []
        size, end = np.fromiter(map(len, parts), np.int64, len(parts)), np.zeros(len(parts), np.int64)
        order = np.argsort(size, kind="stable")
        lengths, starts = np.unique(size[order], return_index=True)
        for n, at, to in zip(lengths, starts, [*starts[1:], len(parts)]):
            most = max(1, 400_000 // int(n * min(n, self.vocabulary.longest)))
            for chunk in _runs(order[at:to], most):
                share, piece = _filter(self.vocabulary, codes_of([parts[k] for k in chunk]))
                end[chunk] = self.first.size + np.arange(len(chunk)) * n + n - 1
                self._append(share, piece)
        self.size.add(size)
        self.end.add(end)

    def _append(self, share: np.ndarray, piece: np.ndarray) -> None:
        edge = np.nonzero(share > 0)
        place = edge[0] * share.shape[1] + edge[1]  # every node has an edge
        first = np.flatnonzero(np.diff(place, prepend=-1))
        total = np.cumsum(share[edge])
        before = np.concatenate([[0.0], total[first[1:] - 1]])
        cum = total - np.repeat(before, np.diff(np.append(first, len(place))))
        cum[np.append(first[1:], len(place)) - 1] = 1.0
        self.first.add(first + self.cum.size)
        self.cum.add(cum)
        self.back.add(edge[2] + 1)
        self.ids.add(piece[edge])

    def sample(self, part: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each occurrence of a part, in order, and how many each has."""
        first, cum, back, ids = (a.data for a in (self.first, self.cum, self.back, self.ids))
        left, node = self.size.data[part], self.end.data[part]
        live, steps, count = np.arange(len(part)), [], np.zeros(len(part), np.int64)
        while len(live):
            salt = np.uint64((len(steps) + 1) * STEP & (1 << 64) - 1)
            u = (mix(seed[live] + salt) >> np.uint64(11)) * 2.0 ** -53
            edge = first[node]
            past = np.flatnonzero(cum[edge] <= u)
            while len(past):
                edge[past] += 1
                past = past[cum[edge[past]] <= u[past]]
            steps.append((live, ids[edge]))
            width = back[edge]
            count[live] += 1
            node, left = node - width, left - width
            more = np.flatnonzero(left > 0)
            live, node, left = live[more], node[more], left[more]
        last = np.cumsum(count) - 1
        out = np.empty(int(count.sum()), np.int32)
        for k, (which, piece) in enumerate(steps):
            out[last[which] - k] = piece
        return out, count


def _runs(values: np.ndarray, size: int):
    return (values[k:k + size] for k in range(0, len(values), size))


def _filter(vocabulary: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share and id of the piece of each length that ends at each node, shape (parts, n, longest).

    Characters without a piece have the id -1 - code point.
    """
    count, n = codes.shape
    widest = min(n, vocabulary.longest)
    weight = np.full((count, n, widest), -np.inf)
    piece = np.zeros((count, n, widest), np.int64)
    spread = mix(codes.astype(np.uint64).ravel() + np.uint64(1)).reshape(codes.shape)
    hashes = np.zeros_like(spread)
    for w in range(1, widest + 1):
        hashes = hashes[:, :n - w + 1] * BASE + spread[:, w - 1:]
        at = vocabulary.slots(hashes, w)
        weight[:, w - 1:, w - 1] = vocabulary.weights[at]
        piece[:, w - 1:, w - 1] = vocabulary.ids[at]
        if w == 1:
            bare = np.isneginf(weight[:, :, 0])
            weight[:, :, 0][bare] = vocabulary.fallback
            piece[:, :, 0] = np.where(bare, -1 - codes.astype(np.int64), piece[:, :, 0])
    total = np.zeros((count, n + 1))
    for e in range(1, n + 1):
        k = min(e, widest)
        paths = weight[:, e - 1, :k] + total[:, e - k:e][:, ::-1]
        top = paths.max(axis=1)
        total[:, e] = top + np.log(np.exp(paths - top[:, None]).sum(axis=1))
        weight[:, e - 1, :k] = np.exp(paths - total[:, e, None])
        weight[:, e - 1, k:] = 0
    return weight, piece


def _with_bytes(vocabulary: Vocabulary, ids: np.ndarray, owner: np.ndarray):
    """Put the bytes of characters without a piece in place of their mark."""
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids, owner
    known, which = np.unique(ids[odd], return_inverse=True)
    chars = (MARK if chr(-1 - k) == RAW_MARK else chr(-1 - k) for k in known.tolist())
    spelled = [[vocabulary.byte_ids[b] for b in c.encode()] for c in chars]
    width = np.ones(len(ids), np.int64)
    width[odd] = np.array([len(s) for s in spelled])[which]
    out, first = np.repeat(ids, width), np.cumsum(width) - width
    for k, s in enumerate(spelled):
        at = first[odd[which == k]]
        for j, b in enumerate(s):
            out[at + j] = b
    return out, np.repeat(owner, width)


def encode(lattices: Lattices, keys: list, texts: list[str | None]):
    """Sampled ids of all texts in one array, and the offsets of each text."""
    import xxhash

    part, sizes = lattices.numbers(texts)
    own = np.array([xxhash.xxh3_64_intdigest(str(k)) for k in keys], np.uint64)
    place = np.arange(1, len(part) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    seed = mix(np.repeat(own, sizes) + PLACE * place.astype(np.uint64))
    ids, count = lattices.sample(part, seed)
    owner = np.repeat(np.repeat(np.arange(len(texts)), sizes), count)
    ids, owner = _with_bytes(lattices.vocabulary, ids, owner)
    return ids, np.searchsorted(owner, np.arange(len(texts) + 1))


def decode(vocabulary: Vocabulary, ids: list[list[int]]) -> list[str]:
    return vocabulary.model.decode(ids) if ids else []


@kept
def vocabulary_of(path: str, theta: float) -> Vocabulary:
    return Vocabulary(path, theta)


def _encode(path: str, theta: float):
    def make():
        vocabulary = vocabulary_of(path, theta)
        lattices = Lattices(vocabulary)

        def step(batch):
            texts = batch.column(1).to_pylist()
            ids, offsets = encode(lattices, batch.column(0).to_pylist(), texts)
            same = []
            for few in _runs(np.arange(len(texts)), FEW):
                lists = [ids[offsets[k]:offsets[k + 1]].tolist() for k in few]
                same += [back == (texts[k] or "") for k, back in zip(few, decode(vocabulary, lists))]
            column = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            return [batch.column(0), np.diff(offsets).tolist(), column, same]

        return step

    return make


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 theta: float = THETA) -> DataFrame:
    """Columns ``id_col``, n_pieces, ids and lossless (they decode to the text) of each row."""
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    found = map_rows(rows, _encode(path, theta),
                     f"id {type_of(rows, 'id')}, n_pieces long, ids array<int>, lossless boolean",
                     256)
    return found.withColumnRenamed("id", id_col)


def _decode(path: str):
    def make():
        vocabulary = vocabulary_of(path, THETA)

        def step(batch):
            return [batch.column(0), decode(vocabulary, [x or [] for x in batch.column(1).to_pylist()])]

        return step

    return make


def decode_texts(encoded: DataFrame, path: str, id_col: str = "doc_id",
                 ids_col: str = "ids") -> DataFrame:
    """Columns ``id_col`` and text; null ids decode to the empty text."""
    rows = encoded.select(quoted(id_col).alias("id"), quoted(ids_col).cast("array<int>").alias("ids"))
    found = map_rows(rows, _decode(path), f"id {type_of(rows, 'id')}, text string", 256)
    return found.withColumnRenamed("id", id_col)
