"""Stored tables: immutable Parquet folders and an append-only log of versions."""

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace as altered
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ordertide.operators.changes import merge_changes, net_changes
from ordertide.operators.checks import duplicates
from ordertide.operators.history import changed_groups, in_groups, scd2_apply
from ordertide.operators.upsert import replace_window, same_key, upsert
from ordertide.sources.scratch import settle

LOG = """version long, feed string, batches map<string,long>, columns string, folders map<string,string>,
lacks map<string,array<string>>,
stats map<string,struct<rows:long,low:long,high:long,print:string>>, repeats long,
watched map<string,struct<slices:int,failing:map<string,long>>>"""

LAYERS = ["raw", "staging", "marts", "snapshots"]

WHOLE = "'all'"
BY_MONTH = "coalesce(date_format(order_date, 'yyyy-MM'), 'none')"
BY_LAST_MONTH = "coalesce(date_format(last_order_date, 'yyyy-MM'), 'none')"
BY_VALIDITY = f"coalesce('closed-' || date_format(valid_to, 'yyyy-MM'), 'open-' || {BY_MONTH})"
BY_ORDER_MONTH = "order_month"


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    """One database per layer, under exactly these names after ``prefix``; they hold views only.

    Jobs of several roots that share a catalog each need a prefix of their own.
    """
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{root}/{prefix}{layer}'")


# The low 21 bits of a long.
LOW = (1 << 21) - 1

# In the log of a history: the moment of its newest versions, and what they were compared with.
HISTORY, SEEN = "history", "seen"


def _micros(moment) -> int:
    """Microseconds of a moment without a zone, given as text or datetime."""
    when = moment if isinstance(moment, datetime) else datetime.fromisoformat(str(moment))
    return int((when.replace(tzinfo=None) - datetime(1970, 1, 1)) // timedelta(microseconds=1))


def _is_month(name: str) -> bool:
    return len(name) == 7 and name[:4].isdigit()


def row_prints(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row; NULL counts as a value of its own.

    Added up over rows in any order they tell two sets of rows apart, copies
    included, up to an accident of 128 bits.
    """
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(salt), *values, *map(F.isnull, values)) for salt in (1, 2)]


def added_up(prints: Column) -> Column:
    """The exact sum of 64-bit hashes, added as three longs, which no 2^41 rows overflow."""
    parts = [prints.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(prints, 21).bitwiseAND(F.lit(LOW)),
             F.shiftright(prints, 42)]
    whole = [F.sum(part).cast("decimal(20,0)") * F.lit(1 << 21 * i).cast("decimal(14,0)")
             for i, part in enumerate(parts)]
    return reduce(Column.__add__, whole).cast("decimal(38,0)")


@dataclass(frozen=True)
class Version:
    """A committed version.

    number, feed and batches: its place in the log, the feed it came from, and the last batch
    of every feed in it. folders: where each slice is; lacks: the columns a slice was written
    without. Of tables with a key, stats: rows, range of keys and maybe the fingerprint of each
    slice, and repeats: how many keys are there more than once. watched: of each write with
    slices in use, how many slices it wrote and how many rows failed each watched test.
    """

    number: int
    feed: str | None
    batches: dict[str, int]
    schema: T.StructType
    folders: dict[str, str]
    lacks: dict[str, list[str]] = field(default_factory=dict)
    stats: dict[str, dict] = field(default_factory=dict)
    repeats: int | None = None
    watched: dict[str, dict] = field(default_factory=dict)

    def write_of(self, name: str) -> str:
        """Number of the version that wrote a slice."""
        return self.folders[name].split("/")[1].removeprefix("v=")

    def entry(self) -> str:
        """Its line in the log."""
        return json.dumps(asdict(self) | {
            "version": self.number, "schema": None, "columns": self.schema.json()})


class Table:
    """A table at ``root``, cut into slices by the SQL expression ``slice_by``.

    A write puts whole new slices into a folder of their own and then appends
    one row to the log; until that row is there readers see the version before,
    so a lost executor or driver leaves no half-written table and the write can
    simply be run again. A change rewrites the slices it touches and no others.
    Slices are few by design (months), rows in them are not: REBALANCE spreads
    a large slice over many files and keeps a small one in a single file. Files
    of months are sorted by day, so a bound on the day skips most of a file.
    One writer at a time, as in a daily job.

    ``key``: a whole-numbered column whose range is kept for each slice, so that slices
    which cannot hold a key are not opened.
    ``unique``: the key should hold each value once. Repeats are counted while
    versions follow each other: slices that stayed have none among themselves if the
    version before had none, so only new slices are looked through, and those old
    ones whose range of keys meets theirs.
    ``prints``: slices also get a fingerprint, so that two versions can be compared
    slice by slice without reading them.
    ``watch``: gives named tests that rows fail; failing rows are counted while a
    version is written, or in the pass that finds the range of its keys.
    ``held``: the newest version is kept in memory, for a run that is the only writer.
    """

    def __init__(self, spark: SparkSession, root: str, slice_by: str = WHOLE, key: str | None = None,
                 unique: bool = False, prints: bool = False,
                 watch: Callable[[], dict[str, Column]] = dict, held: bool = False):
        self.spark, self.root, self.slice_by = spark, root.rstrip("/"), slice_by
        self.key, self.unique, self.prints, self.watch, self.held = key, unique, prints, watch, held
        self.sort_by = ["slice", "order_date"] if slice_by == BY_MONTH else ["slice"]
        self._newest: Version | None = None

    # -- reading -----------------------------------------------------------

    def version(self, number: int | None = None) -> Version | None:
        """The newest version, or the one asked for; None if there is none."""
        known = self._newest
        if self.held and known is not None and number in (None, known.number):
            return known
        try:
            log = self.spark.read.schema(LOG).json(f"{self.root}/log")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if number is not None:
            log = log.filter(F.col("version") == number)
        row = log.orderBy(F.desc("version")).first()
        if row is None:
            return None
        found = Version(
            row["version"], row["feed"], row["batches"] or {},
            T.StructType.fromJson(json.loads(row["columns"])), row["folders"], row["lacks"] or {},
            {s: stat.asDict() for s, stat in (row["stats"] or {}).items()}, row["repeats"],
            {w: seen.asDict() for w, seen in (row["watched"] or {}).items()})
        if number is None:
            self._newest = found
        return found

    def read(self, slices=None, number: int | None = None) -> DataFrame:
        """The rows of the newest (or given) version, of all or some slices."""
        version = self.version(number)
        if version is None:
            raise LookupError(f"no table at {self.root}")
        return self._read(version, slices)

    @staticmethod
    def _by_columns(version: Version, slices) -> list[tuple[list[str], list[str]]]:
        """Folders of the slices, together where they lack the same columns."""
        groups: dict[tuple, list[str]] = {}
        for name in sorted(slices):
            groups.setdefault(tuple(version.lacks.get(name, [])), []).append(version.folders[name])
        return [(list(lacking), folders) for lacking, folders in sorted(groups.items())]

    def _read(self, version: Version, slices=None) -> DataFrame:
        """Rows in the version's columns; NULL where a slice was written without one."""
        wanted = version.folders.keys() if slices is None else version.folders.keys() & set(slices)
        parts = []
        for lacking, folders in self._by_columns(version, wanted):
            stored = T.StructType([f for f in version.schema.fields if f.name not in lacking])
            rows = self.spark.read.schema(stored).parquet(*[f"{self.root}/{f}" for f in folders])
            if lacking:
                rows = rows.select(*[
                    (F.lit(None).cast(f.dataType) if f.name in lacking else F.col(f"`{f.name}`")).alias(f.name)
                    for f in version.schema.fields])
            parts.append(rows)
        if not parts:
            return self.spark.createDataFrame([], version.schema)
        return reduce(DataFrame.unionByName, parts)

    def read_from(self, day: date) -> DataFrame:
        """The rows of all months that can hold ``day`` or a later one.

        For a table cut BY_MONTH; folders of earlier months are not even listed.
        """
        version = self.version()
        first = f"{day:%Y-%m}".zfill(7)
        return self._read(version, [s for s in version.folders if not _is_month(s) or s >= first])

    def read_newest(self) -> DataFrame:
        """Rows that include the newest day of a table cut by months."""
        version = self.version()
        names = list(version.folders)
        if "none" in names:
            names.remove("none")
        return self._read(version, [max(names)] if names and all(map(_is_month, names)) else None)

    def publish(self, layer: str, name: str) -> None:
        """Point the view ``layer.name`` at the newest version."""
        version = self.version()

        def column(f: T.StructField, absent: bool) -> str:
            return f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" if absent else f"`{f.name}`"

        rows = []
        for lacking, folders in self._by_columns(version, version.folders):
            columns = ", ".join(column(f, f.name in lacking) for f in version.schema.fields)
            rows.append(f"SELECT {columns} FROM parquet.`{self.root}/{{{','.join(folders)}}}`")
        if not rows:
            rows = [f"SELECT {', '.join(column(f, True) for f in version.schema.fields)} WHERE false"]
        self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {' UNION ALL '.join(rows)}")

    # -- comparing versions ------------------------------------------------

    def _same(self, a: Version, b: Version, name: str) -> bool:
        """Whether a slice holds the same rows in both versions, as far as the log can tell."""
        if name not in a.folders or name not in b.folders:
            return False
        if a.folders[name] == b.folders[name]:
            return True
        old, new = a.stats.get(name), b.stats.get(name)
        return self.prints and old is not None and old == new and old["print"] is not None and (
            a.schema.names == b.schema.names)

    def changed_slices(self, since: int) -> set[str]:
        """Names of slices whose rows may differ between version ``since`` and the newest."""
        old, new = self.version(since), self.version()
        if old is None:
            return set(new.folders)
        return {s for s in old.folders.keys() | new.folders.keys() if not self._same(old, new, s)}

    def read_near(self, slices: set[str], since: int) -> DataFrame:
        """Rows of the other slices in whose range keys lie that ``slices`` have, or had at ``since``."""
        old, version = self.version(since), self.version()
        ends = [v.stats[s] for s in slices for v in (old, version) if s in v.stats]
        return self._read(version, self._in_range(version, version.folders.keys() - slices, ends))

    @staticmethod
    def _in_range(version: Version, slices, ends: list[dict]) -> list[str]:
        """Those of the slices whose range of keys meets the range over ``ends``."""
        lows = [e["low"] for e in ends if e["low"] is not None]
        highs = [e["high"] for e in ends if e["high"] is not None]
        if not lows:
            return []
        low, high = min(lows), max(highs)

        def meets(stat: dict | None) -> bool:
            return stat is None or stat["low"] is not None and stat["low"] <= high and stat["high"] >= low

        return [s for s in slices if meets(version.stats.get(s))]

    # -- writing -----------------------------------------------------------

    def replace(self, rows: DataFrame, feed: str | None = None, batch: int | None = None,
                clustered: bool = False) -> int:
        """Full rebuild; returns the number of rows stored.

        ``clustered`` says that each task's rows belong to few slices already, as
        those read from a table cut the same way; they are not shuffled then.
        """
        return self._commit(rows, self.version(), {}, feed, batch, clustered)

    def replace_slices(self, rows: DataFrame, slices: set[str], feed: str, batch: int) -> int:
        """Rows take the place of whole slices, those that have none any more included."""
        version = self.version()
        if version is None:
            return self.replace(rows, feed, batch)
        return self._rewrite(version, slices, rows, feed, batch)

    def _rewrite(self, version: Version, touched, rows: DataFrame,
                 feed: str | None = None, batch: int | None = None) -> int:
        kept = {s: f for s, f in version.folders.items() if s not in touched}
        return self._commit(rows, version, kept, feed, batch)

    def _commit(self, rows: DataFrame, before: Version | None, kept: dict[str, str],
                feed: str | None, batch: int | None, clustered: bool = False, seen: int | None = None) -> int:
        number = 1 if before is None else before.number + 1
        folder = f"data/v={number}"
        placed = rows.withColumn("slice", F.expr(self.slice_by))
        if self.slice_by == WHOLE:
            placed = placed.hint("rebalance")
        elif not clustered:
            placed = placed.hint("rebalance", "slice")

        def write(rows: DataFrame) -> None:
            rows.sortWithinPartitions(*self.sort_by).write.mode("overwrite").partitionBy(
                "slice"
            ).parquet(f"{self.root}/{folder}")

        if self.key is not None:
            write(placed)
            written = self._written(folder, rows.schema)
            slices, count = [r["slice"] for r in written], sum(r["rows"] for r in written)
            failing = {name: sum(r[f"n{i}"] for r in written) for i, name in enumerate(self.watch())}
        else:
            # Observed after the last shuffle, where a task that runs again is not counted twice.
            observed, watch = Observation(), self.watch()
            write(placed.observe(
                observed, F.count(F.lit(1)).alias("rows"), F.collect_set("slice").alias("slices"),
                *[F.count_if(fails).alias(f"n{i}") for i, fails in enumerate(watch.values())]))
            found = observed.get
            slices, count = found["slices"], found["rows"]
            failing = {name: found[f"n{i}"] for i, name in enumerate(watch)}
        fresh = {name: f"{folder}/slice={name}" for name in slices}
        batches = {} if before is None else {f: n for f, n in before.batches.items() if f != SEEN}
        batches |= {f: n for f, n in ((feed, batch), (SEEN, seen)) if f is not None and n is not None}
        watched = {str(number): {"slices": len(fresh), "failing": failing}}
        lacks, stats = {}, {}
        if before is not None:
            used = {before.write_of(s) for s in kept}
            watched |= {w: tests for w, tests in before.watched.items() if w in used}
            names = set(rows.columns)
            added = names - set(before.schema.names)
            lacks = {s: sorted((names & set(before.lacks.get(s, []))) | added) for s in kept}
            stats = {s: before.stats[s] for s in kept if s in before.stats}
        version = Version(number, feed, batches, rows.schema, {**kept, **fresh},
                          {s: c for s, c in lacks.items() if c}, stats, None, watched)
        if self.key is not None:
            stats |= {r["slice"]: {k: r[k] for k in ("rows", "low", "high", "print")} for r in written}
        if self.unique:
            version = altered(version, repeats=self._repeats_of(version, before))
        self._log(version)
        return count

    def _log(self, version: Version) -> None:
        line = self.spark.range(1).coalesce(1).select(F.lit(version.entry()).alias("value"))
        line.write.mode("append").text(f"{self.root}/log")
        self._newest = version

    def _written(self, folder: str, schema: T.StructType) -> list:
        """Of the slices just written: rows, range of keys, fingerprint, and how many rows fail each
        watched test, in one pass without a shuffle of rows.

        It reads the key and the tested columns, all for fingerprints: cheaper than observing
        rows on their way to the files, where Spark evaluates every test by interpretation.
        """
        stored = T.StructType([*schema.fields, T.StructField("slice", T.StringType())])
        key = F.col(self.key)
        prints = [added_up(h).cast("string") for h in row_prints(schema.names)]
        print_ = F.concat_ws(":", *prints) if self.prints else F.lit(None).cast("string")
        return self.spark.read.schema(stored).parquet(f"{self.root}/{folder}").groupBy("slice").agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).cast("long").alias("low"),
            F.max(key).cast("long").alias("high"), print_.alias("print"),
            *[F.count_if(fails).alias(f"n{i}") for i, fails in enumerate(self.watch().values())]).collect()

    def _repeats_of(self, version: Version, before: Version | None) -> int:
        """How many keys of the version are there more than once; NULL is no key."""
        key = F.col(self.key)
        if before is None or before.repeats != 0:
            return duplicates(self._read(version).select(key), self.key).count()
        same = {s for s in version.folders if self._same(before, version, s)}
        fresh = version.folders.keys() - same
        if not fresh:
            return 0
        ends = [version.stats[s] for s in fresh]
        ids = self._read(version, fresh).select(key).filter(key.isNotNull())
        near = self._in_range(version, same, ends)
        if near:
            low, high = (f(e[k] for e in ends if e[k] is not None) for f, k in ((min, "low"), (max, "high")))
            others = self._read(version, near).select(key).filter(key.between(low, high))
            ids = ids.unionByName(others.join(ids.distinct(), self.key, "left_semi"))
        return duplicates(ids, self.key).count()

    # -- watched tests -------------------------------------------------------

    def failing(self) -> dict[str, int]:
        """Rows that fail each watched test, from what was counted when they were written.

        Counts are kept per write. Where rows failed and some of the write's slices
        were replaced since, those that are left are read and counted again.
        """
        version, watch = self.version(), self.watch()
        live: dict[str, list[str]] = {}
        for name in version.folders:
            live.setdefault(version.write_of(name), []).append(name)
        counts, again = dict.fromkeys(watch, 0), {}
        for write, slices in live.items():
            seen = version.watched.get(write, {"slices": -1, "failing": {}})
            for name in watch:
                n = seen["failing"].get(name)
                if n is not None and (n == 0 or len(slices) == seen["slices"]):
                    counts[name] += n
                else:
                    again.setdefault(name, []).extend(slices)
        if again:
            place = F.expr(self.slice_by)
            rows = self._read(version, {s for several in again.values() for s in several})
            row = rows.agg(*[F.count_if(place.isin(*slices) & watch[name]).alias(f"n{i}")
                             for i, (name, slices) in enumerate(again.items())]).first()
            for i, name in enumerate(again):
                counts[name] += row[f"n{i}"]
        return counts

    # -- slices ------------------------------------------------------------

    def _slices_of(self, rows: DataFrame) -> set[str]:
        return {r[0] for r in rows.select(F.expr(self.slice_by)).distinct().collect()}

    def _slices_with(self, version: Version, keys: DataFrame) -> set[str]:
        """Slices that hold one of the keys: reads the key and slice columns only.

        The range of the keys goes into the scan first, which skips most files
        where keys grow with time; the semi join then decides exactly.
        """
        if len(version.folders) < 2:
            return set(version.folders)
        rows = self._read(version)
        ends = keys.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys.columns
                          for f in (F.min, F.max)]).first()
        for k in keys.columns:
            if ends[f"min_{k}"] is not None:
                inside = F.col(k).between(ends[f"min_{k}"], ends[f"max_{k}"])
                rows = rows.filter(inside | F.col(k).isNull())
        match = same_key("t", "k", keys.columns)
        return self._slices_of(rows.alias("t").join(keys.alias("k"), match, "left_semi"))

    # -- maintenance -------------------------------------------------------

    def upsert(self, updates: DataFrame, keys: list[str]) -> int:
        """Replace rows by key, add the others; columns follow ``updates``."""
        version = self.version()
        if version is None:
            return self.replace(updates)
        updates = settle(updates)
        if self._retyped(version, updates):
            touched = set(version.folders)
        else:
            touched = self._slices_with(version, updates.select(*keys))
        touched |= self._slices_of(updates)
        rows = upsert(self._read(version, touched), updates, keys)
        return self._rewrite(version, touched, rows)

    @staticmethod
    def _retyped(version: Version, rows: DataFrame) -> bool:
        """Whether a stored column has another type now, so that all slices must be written anew.

        Columns that came or went need no rewriting: slices are read without them.
        """
        kinds = {f.name: f.dataType for f in version.schema.fields}
        return any(kinds.get(f.name, f.dataType) != f.dataType for f in rows.schema.fields)

    def replace_since(self, updates: DataFrame, day: str, since: Column) -> int:
        """Replace all rows from the day ``since`` on."""
        version = self.version()
        if version is None:
            return self.replace(updates)
        updates = settle(updates)
        if self._retyped(version, updates):
            touched = set(version.folders)
        else:
            touched = self._slices_of(self._read(version).filter(F.col(day) >= since))
        touched |= self._slices_of(updates)
        rows = replace_window(self._read(version, touched), updates, day, since)
        return self._rewrite(version, touched, rows)

    def merge(self, feed_rows: DataFrame, key: str, loaded_at,
              feed: str | None = None, batch: int | None = None) -> int:
        """Merge the net effect of a feed batch; one not after the feed's last is skipped.

        Each feed has its own count of batches, so several may take turns. The feed
        is settled before it is folded: folding reads events twice and drops NULL
        keys, and such a filter, pushed into one of the feed's two uses of the states
        it compares, would have Spark read and shuffle both states a second time.
        """
        version = self.version()
        if version is None:
            raise LookupError(f"load {self.root} before merging changes into it")
        if feed is not None and version.batches.get(feed, batch - 1) >= batch:
            return 0
        changes = settle(net_changes(settle(feed_rows), key))
        touched = self._slices_of(changes.filter("_action = 'INSERT'"))
        touched |= self._slices_with(version, changes.select(key))
        rows = merge_changes(self._read(version, touched), changes, key, loaded_at)
        return self._rewrite(version, touched, rows, feed, batch)

    def remember(self, source: DataFrame, key: str, tracked: list[str], as_of,
                 changed: DataFrame | None = None, seen: int | None = None,
                 clustered: bool = False) -> int:
        """Bring a history cut BY_VALIDITY up to ``as_of``.

        Open versions are compared with the source on key and tracked values;
        only the months with a version to close or open are then rewritten.

        ``changed`` (settled): what the comparison would find, where it is known
        already; ``source`` then needs only the rows of changed groups, and of the
        open versions those months are read that may hold a changed key. ``seen``
        is the source's version, to be found in the log (``source_seen``). ``clustered``:
        the source is cut by months, as ``replace`` takes it; for a first load.
        """
        version, stamp = self.version(), _micros(as_of)
        if version is None:
            first = scd2_apply(None, source, key, tracked, as_of)
            return self._commit(first, None, {}, HISTORY, stamp, clustered, seen)
        if version.batches.get(HISTORY, stamp) > stamp:
            raise ValueError(f"history at {self.root} has versions made after {as_of}")
        months = [s for s in version.folders if s.startswith("open-")]
        if changed is None:
            changed = changed_groups(self._read(version, months), source, key, tracked)
        elif self.key == key:
            ends = changed.agg(F.min(key).alias("low"), F.max(key).alias("high")).first().asDict()
            months = self._in_range(version, months, [ends])
        standing, now = self._read(version, months), F.lit(as_of).cast("timestamp_ntz")
        ended = in_groups(standing, changed.filter("was"), key, tracked)
        opened = in_groups(source, changed.filter("is"), key, tracked).withColumn(
            "valid_to", F.lit(None).cast("timestamp_ntz"))
        touched = self._slices_of(ended) | self._slices_of(opened)
        touched |= self._slices_of(ended.withColumn("valid_to", now))
        if not touched:
            if seen is not None:  # nothing to write, but the source is newer
                self._log(altered(version, number=version.number + 1, batches={**version.batches, SEEN: seen}))
            return 0
        rows = scd2_apply(self._read(version, touched), source, key, tracked, as_of, changed)
        kept = {s: f for s, f in version.folders.items() if s not in touched}
        return self._commit(rows, version, kept, HISTORY, stamp, seen=seen)

    def source_seen(self) -> int | None:
        """The version of the source that a history's open versions stand for."""
        version = self.version()
        return None if version is None else version.batches.get(SEEN)

    def read_valid(self, moment: datetime) -> DataFrame:
        """Versions of a history cut BY_VALIDITY that may be valid at ``moment`` or later."""
        version, first = self.version(), f"closed-{moment:%Y-%m}"
        return self._read(
            version, [s for s in version.folders if s.startswith("open-") or s >= first])
