"""Jaccard join of word-shingle sets with count-vector R-trees.

Two texts link when the Jaccard similarity of their sets of ``n``-word shingles is
at least ``percent`` per cent; the result is every text's component of links.

Texts with equal sets form a class; from here on classes are joined, so copies of a
text cost one row. A class is then

* spread by pigeonhole keys: linked sets differ in at most D shingles (D follows from
  the sizes), so of more than D groups of shingles (by hash) one is equal in both. A
  key is a group's number and content; classes that share no key cannot link. Sizes
  are cut into overlapping levels with a fixed number of groups, so both sides use the
  same ones; of its groups a set uses the D + 1 with most shingles (``keys`` says why).
  Keys go from the texts straight into one shuffle that sorts them; each task then
  streams past equal keys and links their classes to the first. Nothing of their size
  is stored.
* joined in blocks: classes that share keys, directly or by others, are sent to one
  block, as texts, which are half as large as their sets. There the shingles are hashed
  into ``GROUPS`` groups once more, the counts
  per group are the class's point, and the points go into an R-tree. The summed
  minima of two points' coordinates bound the overlap of their sets from above, and
  those of a point and a node's upper corner the overlap with all sets below it.
  Pairs that the tree leaves are verified on the sets. A pair already known to be in
  one component is not verified again, so a large group of near copies costs about
  as many verifications as it has members.

A group too large for one block is dealt over several at random, joined there, and
its components are merged; keys whose classes are all in one component then drop
out, and the rest is grouped by other keys and dealt anew. What still spans blocks after ``DEALS`` rounds meets
in every pair of blocks. Nothing is dropped at any size.

Words are separated by ASCII white space, compared after lower-casing A-Z. A text
with fewer than ``n`` words has its whole sequence as one shingle; a text without
words (or null) has none and links with nothing. Shingles are 64-bit hashes. The
component of a text is the smallest id in it (null if all ids in it are null);
repeated rows and ids are rows of their own.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordertide.llm.common import WordHashes, few_files, map_rows, mix, quoted, type_of
from ordertide.sources.scratch import settle

SHINGLE, PERCENT = 3, 90
RATIO = 1.4  # upper end of a level of sizes over its lower end
GROUPS, LEAF, FANOUT = 32, 8, 8
BLOCK = 2_000_000  # shingles in a block, each class counting OVERHEAD more
OVERHEAD, DEALS = 200, 3
SMALL, FEW = 1_000_000, 250_000  # rows of 16 and of 64 bytes that are broadcast at most


# -- sets and keys ---------------------------------------------------------------


def shingles(text: str | None, hashes: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = hashes.of(words)
    width = min(n, len(words))
    found = np.full(len(codes) - width + 1, width if width < n else 0, np.uint64)
    for k in range(width):
        found = mix(found + codes[k:len(codes) - width + 1 + k])
    return np.unique(found)


def most_different(total: int, percent: int) -> int:
    """Largest symmetric difference of linked sets whose sizes add up to ``total`` at most."""
    return (100 - percent) * total // (100 + percent)


def levels(size: int, percent: int) -> list[tuple[int, int]]:
    """(lower end, upper end) of the one or two levels of a size.

    Level k holds the sizes from b(k) to b(k+1) * 100 / percent, so the sizes of
    linked sets always have a level in common.
    """
    found, low = [], 1
    while low <= size:
        after = max(low + 1, int(low * RATIO))
        top = (after - 1) * 100 // percent
        if size <= top:
            found.append((low, top))
        low = after
    return found


def keys(found: np.ndarray, percent: int, family: int = 0) -> np.ndarray:
    """Pigeonhole keys; linked sets that are not equal share one.

    Linked sets of a level differ in ``most`` groups at most, so all but ``most`` of the
    filled groups of either are filled equally in the other. Of all groups that are, the
    first by (most shingles, then by hash) has at most ``most`` others before it on
    either side: the first ``most + 1`` groups are enough, and those with few shingles,
    which unrelated texts share most easily, are left out. Only a set with no more
    filled groups than that may share an empty one, whose number is a key then.
    ``family`` numbers other ways to form groups.
    """
    out, size = [], len(found)
    spread = mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5 + family))
    place = mix(found + np.uint64(family)) if family else found
    for low, top in levels(size, percent):
        if most_different(2 * top, percent) == 0:
            continue
        most = most_different(size + min(top, 100 * size // percent), percent)
        groups = most_different(2 * top, percent) * 26 // 25 + 4  # more than any ``most``, as some may be empty
        group = (place % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        number = group[order][first].astype(np.uint64)
        salt = np.uint64(low) << np.uint64(32)
        filled = mix(np.add.reduceat(spread[order], first) + mix(number + salt))
        if len(first) > most:
            strong = np.lexsort([filled, -np.diff(np.append(first, size))])
            filled = filled[strong[:most + 1]]
        else:
            lacking = np.setdiff1d(np.arange(groups), group).astype(np.uint64)
            out.append(mix(mix(lacking + salt) + np.uint64(1)))
        out.append(filled)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def node_of(found: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(found.tobytes())


def short_of(node: bytes) -> int:
    """Eight bytes of a class's name. Two classes that share them meet in a block, no more."""
    return int.from_bytes(node[:8], "little", signed=True)


# -- joining a block -----------------------------------------------------------------


class CountTree:
    """R-tree over count vectors, packed bottom-up; all nodes of a level are arrays."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = self._packed(np.arange(len(points)))
        self.levels = []  # upper corners and least and greatest size, leaves first
        upper, least = points[self.order], points[self.order].sum(axis=1)
        most, width = least, LEAF
        while True:
            cut = np.arange(0, len(upper), width)
            upper = np.maximum.reduceat(upper, cut, axis=0)
            least, most = np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)
            self.levels.append((upper, least, most, width))
            if len(upper) == 1:
                break
            width = FANOUT

    def _packed(self, rows: np.ndarray) -> np.ndarray:
        """Rows in an order that keeps near points together: halves along the widest axis."""
        stack, done = [rows], []
        while stack:
            part = stack.pop()
            if len(part) <= LEAF:
                done.append(part)
                continue
            points = self.points[part]
            axis = int((points.max(axis=0) - points.min(axis=0)).argmax())
            half = (len(part) // 2 + LEAF - 1) // LEAF * LEAF
            ranked = part[np.argsort(points[:, axis], kind="stable")]
            stack += [ranked[half:], ranked[:half]]
        return np.concatenate(done) if done else rows

    def search(self, point: np.ndarray, percent: int) -> np.ndarray:
        """Rows whose sets may link with the point's set."""
        size, nodes = int(point.sum()), np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least, most, width = self.levels[depth]
            nodes = nodes[_may_link(point, size, upper[nodes], least[nodes], most[nodes], percent)]
            nodes = (nodes[:, None] * width + np.arange(width)).ravel()
            nodes = nodes[nodes < (len(self.levels[depth - 1][0]) if depth else len(self.order))]
        rows = self.order[nodes]
        points = self.points[rows]
        sizes = points.sum(axis=1)
        return rows[_may_link(point, size, points, sizes, sizes, percent)]


def _may_link(point, size, upper, least, most, percent) -> np.ndarray:
    """Whether a set below a node can overlap enough: 100 i >= percent * (a + b - i)."""
    bound = np.minimum(upper, point).sum(axis=1)
    near = (100 * most >= percent * size) & (100 * size >= percent * least)
    return near & ((100 + percent) * bound >= percent * (size + least))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    overlap = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * overlap >= percent * (len(a) + len(b) - overlap)


def count_vector(found: np.ndarray) -> np.ndarray:
    return np.bincount((mix(found) >> np.uint64(59)).astype(np.int64), minlength=GROUPS)


def join_block(sets: list[np.ndarray], known: list, percent: int) -> np.ndarray:
    """Component number of each set; ``known``: components found before."""
    label = np.unique(np.array(known), return_inverse=True)[1]
    tree = CountTree(np.stack([count_vector(s) for s in sets]))
    rank = np.argsort(tree.order)
    for k in tree.order:  # neighbours one after the other, so that they merge early
        near = tree.search(tree.points[k], percent)
        near = near[(label[near] != label[k]) & (rank[near] > rank[k])]
        while len(near):
            other, near = near[0], near[1:]
            if linked(sets[k], sets[other], percent):
                label[label == label[other]] = label[k]
                near = near[label[near] != label[k]]
    return label


def _join(n: int, percent: int):
    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node").sort_values("node").reset_index(drop=True)
        hashes = WordHashes()
        sets = [shingles(t, hashes, n) for t in frame["text"]]
        known = [bytes(own if c is None else c).hex() for own, c in zip(frame["node"], frame["component"])]
        label = join_block(sets, known, percent)
        links = pd.DataFrame({"a": frame["node"], "b": frame.groupby(label)["node"].transform("first")})
        return links[links["a"] != links["b"]]

    return join


# -- components ------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """Columns node and component (its smallest node) of all nodes with a link (a, b).

    Stars are made larger and smaller in turn until every node hangs on the smallest
    of its component. Each step takes a minimum per node, combined before the
    shuffle, and joins it back; a hub of very many links is split by the join.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct())
    seen, count = None, edges.count()
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(few_files(large.filter("a <> b").distinct(), count))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        near = moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        edges = settle(few_files(near, count))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        count = state[0]
        if state == seen:
            break
        seen = state
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


# -- on tables ---------------------------------------------------------------------------


def _nodes_of(n: int):
    def make():
        hashes = WordHashes()

        def step(batch):
            sizes, nodes, shorts = [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text, hashes, n)
                node = node_of(found) if len(found) else None
                sizes.append(len(found))
                nodes.append(node)
                shorts.append(short_of(node) if node else None)
            return [batch.column(0), batch.column(1), sizes, nodes, shorts]

        return step

    return make


def _keys_of(n: int, percent: int, family: int = 0):
    """Rows (key, short); a class that a task meets more than once gives its keys once."""
    def make():
        hashes, seen = WordHashes(), set()

        def step(batch):
            keyed, shorts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for text in batch.column(0).to_pylist():
                found = shingles(text, hashes, n)
                node = node_of(found)
                if len(found) and node not in seen:
                    seen.add(node)
                    keyed.append(keys(found, percent, family))
                    shorts.append(np.full(len(keyed[-1]), short_of(node), np.int64))
            return [pa.array(np.concatenate(keyed).view(np.int64)), pa.array(np.concatenate(shorts))]

        return step

    return make


def _hubs():
    """From rows sorted by key and short: each class with the first class of its keys."""
    last_key = last_hub = None

    def step(batch):
        nonlocal last_key, last_hub
        key, short = (c.to_numpy() for c in batch.columns)
        new = np.concatenate([[key[0] != last_key], key[1:] != key[:-1]])
        begin = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        hub = np.where(begin < 0, short[0] if last_hub is None else last_hub, short[begin])
        last_key, last_hub = key[-1], hub[-1]
        found = np.unique(np.stack([short, hub])[:, short != hub], axis=1)
        return [pa.array(found[0]), pa.array(found[1])]

    return step


def _first_buckets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Rows (short, hub): classes that share a key hang on the same hub, or on hubs that do."""
    keyed = map_rows(docs.select("text"), _keys_of(n, percent), "key long, short long")
    ordered = keyed.repartition("key").sortWithinPartitions("key", "short")
    return map_rows(ordered, _hubs, "short long, hub long", 65_536).distinct()


def _buckets(short: DataFrame, component: DataFrame) -> DataFrame:
    """The same of the keys whose classes are not all in one component."""
    rows = short.join(component, "short", "left")
    name = F.coalesce(F.col("component"), F.unhex(F.hex("short")))
    rows = rows.select("short", "key", name.alias("name"))
    mixed = rows.groupBy("key").agg(F.min("name").alias("low"), F.max("name").alias("high"),
                                    F.min("short").alias("hub"))
    return rows.select("short", "key").join(
        mixed.filter("low <> high").select("key", "hub"), "key").select("short", "hub").distinct()


def _placed(members: DataFrame, deal: int) -> tuple[DataFrame, bool]:
    """Members with the block each goes to, and whether some group spans blocks."""
    weight = F.col("size") + OVERHEAD
    groups = members.groupBy("group").agg(F.sum(weight).alias("weight"))
    groups = settle(groups.withColumn("parts", F.ceil(F.col("weight") / BLOCK).cast("int")))
    whole, split = groups.agg(F.sum("weight"), F.max("parts")).first()
    bins = int((whole or 0) // BLOCK + 1)
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node", F.lit(deal)), F.col("parts"))).otherwise(
        F.lit(-1)).cast("int")
    bin_ = F.when(F.col("parts") > 1, F.col("group")).otherwise(
        F.pmod(F.xxhash64("group"), F.lit(bins)))
    placed = members.join(groups.select("group", "parts"), "group")
    return placed.withColumn("part", part).withColumn("bin", bin_), (split or 0) > 1


def _pairs_of_blocks(placed: DataFrame) -> DataFrame:
    """Members of split groups once for every pair of blocks that their block is in."""
    mates = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    many = placed.filter("parts > 1").withColumn("mate", mates).filter("mate <> part")
    pair = F.xxhash64("group", F.least("part", "mate"), F.greatest("part", "mate"))
    return placed.filter("parts = 1").unionByName(many.withColumn("bin", pair).withColumn("part", F.lit(-1)).drop("mate"))


def _with_texts(docs: DataFrame, chosen: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the chosen classes with the text of each, from its first row.

    A row that is there many times gives its text once per task, and only those rows
    are looked up by a shuffle of their own.
    """
    same = F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.hash") == F.col("c.hash"))
    chosen = settle(chosen.select("id", "hash", "copied", *columns))
    total, copied = chosen.agg(F.count(F.lit(1)), F.count_if("copied")).first()

    def looked_up(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        wanted = F.broadcast(wanted) if total <= FEW else wanted  # beyond that the join shuffles
        return rows.alias("d").join(wanted.alias("c"), same).select(
            *[F.col(f"c.{c}") for c in columns], F.col("d.text"))

    if not copied:
        return looked_up(docs, chosen)
    several = chosen.filter("copied")
    ids = several.select("id", "hash").distinct().alias("c")
    once = docs.alias("d").join(F.broadcast(ids) if total <= FEW else ids, same, "left_semi").select(
        "id", "hash", "text").dropDuplicates(["id", "hash"])
    return looked_up(docs, chosen.filter("NOT copied")).unionByName(looked_up(once, several))


def linked_rows(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """Columns id, hash (of the text), size, node, component_id and first of each row.

    ``first`` has id and hash of the component's first row: the smallest id, nulls last.
    """
    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("hash"),
                       quoted(text_col).alias("text"))
    kind = type_of(rows, "id")
    every = settle(map_rows(
        rows, _nodes_of(n), f"id {kind}, hash long, size long, node binary, short long"))
    distinct = every.filter("node IS NOT NULL").groupBy("node", "short", "size", "id", "hash").agg(
        F.count(F.lit(1)).alias("n"))
    place = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash", "n")).alias("first")
    classes = settle(distinct.groupBy("node", "short", "size").agg(place, F.min("id").alias("least")))
    known = classes.select("short", "node", "size", "first.id", "first.hash",
                           (F.col("first.n") > 1).alias("copied"))

    component = links = short = None
    for deal in range(DEALS + 1):
        if deal == 0:
            hubs = settle(_first_buckets(rows, n, percent))
        else:
            named = component.join(known.select("short", "node"), "node").select("short", "component")
            hubs = settle(_buckets(short, named))
        if hubs.isEmpty():
            break
        group = components(hubs.select(F.col("short").alias("a"), F.col("hub").alias("b")))
        grouped = known.join(group.select(
            F.col("node").alias("short"), F.col("component").alias("group")), "short")
        if component is not None:
            grouped = grouped.join(component, "node", "left")
        else:
            grouped = grouped.withColumn("component", F.lit(None).cast("binary"))
        placed, split = _placed(settle(grouped), deal)
        blocks = _pairs_of_blocks(placed) if split and deal == DEALS else placed
        full = _with_texts(rows, blocks, ["bin", "part", "node", "component"])
        new = full.groupBy("bin", "part").applyInPandas(_join(n, percent), "a binary, b binary")
        links = settle(new if links is None else new.unionByName(links))
        component = settle(components(links))
        if not split:
            break
        # Groups in one block are done; the others are grouped again by another family of keys.
        again = placed.filter("parts > 1").select("short", "id", "hash", "copied").distinct()
        texts = _with_texts(rows, again, ["short"])
        again = map_rows(texts.select("text"), _keys_of(n, percent, deal + 1), "key long, short long")
        short = settle(again.distinct())
    first = classes.select("node", F.struct("first.none", "first.id", "first.hash").alias("first"), "least")
    if component is not None:
        of = first.join(component, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        smallest = of.groupBy("component").agg(F.min("first").alias("first"), F.min("least").alias("least"))
        first = of.select("node", "component").join(smallest, "component")
    joined = every.select("id", "hash", "size", "node").join(
        first.select("node", "first", "least"), "node", "left")
    alone = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("least"))
    return joined.select("id", "hash", "size", "node", alone.alias("component_id"),
                         F.struct("first.id", "first.hash").alias("first"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Columns ``id_col``, n_shingles, node (class of equal sets) and component_id of each row."""
    return linked_rows(docs, id_col, text_col, n, percent).select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "node", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of each component's smallest id (rows without words all stay), all columns.

    Rows with the same id and text are one document; null ids come last.
    """
    found = linked_rows(docs, id_col, text_col, n, percent)
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    gone = settle(found.filter((F.col("size") > 0) & ~same).select("id", "hash").distinct())
    if gone.count() <= SMALL:  # 16 bytes a row; beyond that the join shuffles
        gone = F.broadcast(gone)
    # All columns, however named, travel in one.
    row = F.struct(*[quoted(c).alias(f"c{k}") for k, c in enumerate(docs.columns)])
    packed = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("hash"), row.alias("row"))
    match = F.col("d.id").eqNullSafe(F.col("g.id")) & (F.col("d.hash") == F.col("g.hash"))
    left = packed.alias("d").join(gone.alias("g"), match, "left_anti")
    return left.select("row.*").toDF(*docs.columns)
