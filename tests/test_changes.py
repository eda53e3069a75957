"""Change feed, net effect, merge, stream and history: fixture D and the invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ordertide.operators.changes import change_feed, initial_load, merge_changes, net_changes
from ordertide.operators.history import scd2_apply, state_at
from ordertide.plans.models import stg_orders
from ordertide.plans.refresh import orders_at, refresh_cdc, refresh_history
from ordertide.schema import RAW_ORDERS, feed_schema
from ordertide.sources.tables import BY_MONTH, BY_VALIDITY, Table
from ordertide.streaming.cdc import follow_feed
from tests.fixtures import A, C, as_set, day, raw_orders

T1, T2 = "2025-01-06 00:00:00", "2025-01-07 00:00:00"
KEY, TRACKED = "order_id", ["status", "amount"]
SIX = RAW_ORDERS.names


@pytest.fixture(scope="module")
def states(spark):
    return raw_orders(spark, A), raw_orders(spark, C)


def test_feed(states):
    feed = change_feed(*states, KEY)
    assert as_set(feed, "order_id", "_action", "_is_update", "amount", "status") == {
        (1, "DELETE", True, 120.5, "completed"), (1, "INSERT", True, 120.5, "returned"),
        (2, "DELETE", True, 80.0, "completed"), (2, "INSERT", True, 90.0, "completed"),
        (5, "DELETE", False, 150.0, "completed"), (6, "INSERT", False, 30.0, "completed"),
        (7, "INSERT", False, 10.0, "completed"), (8, "INSERT", False, 280.0, "completed")}
    assert feed.schema.names == feed_schema(RAW_ORDERS).names


def test_feed_of_equal_states_is_empty(spark, states):
    nulls = raw_orders(spark, [(1, None, None, None, None, None), (None, "x", None, float("nan"), "", "")])
    for state in (states[0], nulls):
        assert change_feed(state, state, KEY).count() == 0


def test_merge_leads_to_the_new_state_and_a_replay_changes_nothing(states):
    old, new = states
    target = initial_load(stg_orders(old), T1)
    net = net_changes(change_feed(old, new, KEY), KEY)
    merged = merge_changes(target, net, KEY, T2)
    assert as_set(merged, *SIX) == as_set(new)
    assert as_set(merged, "order_id", "_cdc_action") == {
        (1, "UPDATE"), (2, "UPDATE"), (3, "INITIAL_LOAD"), (4, "INITIAL_LOAD"),
        (6, "INSERT"), (7, "INSERT"), (8, "INSERT")}
    assert merged.schema.names == target.schema.names
    again = merge_changes(merged, net, KEY, T2)
    values = [c for c in merged.columns if c != "_cdc_action"]
    assert as_set(again, *values) == as_set(merged, *values)


FEED = "k int, v int, _action string, _is_update boolean"


def literal(spark, changes, with_seq=False):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    kind = FEED + (", _seq long" if with_seq else "")
    return initial_load(target, T1), spark.createDataFrame(changes, kind)


@pytest.mark.parametrize("changes, expected", [
    ([(1, 10, "DELETE", False), (1, 10, "INSERT", False)], {(2, 20), (3, 30)}),
    ([(2, 20, "DELETE", True), (2, 22, "INSERT", True)], {(1, 10), (2, 22), (3, 30)}),
    ([(3, 33, "INSERT", False)], {(1, 10), (2, 20), (3, 30)}),
    ([(4, 44, "INSERT", True)], {(1, 10), (2, 20), (3, 30), (4, 44)}),
    ([(None, 9, "INSERT", False)], {(1, 10), (2, 20), (3, 30), (None, 9)}),
    ([(7, 0, "DELETE", False)], {(1, 10), (2, 20), (3, 30)}),
    ([(1, 0, "DELETE", True)], {(1, 10), (2, 20), (3, 30)}),
    ([(8, 0, "DELETE", True)], {(1, 10), (2, 20), (3, 30)}),
    ([(5, 55, "INSERT", False)], {(1, 10), (2, 20), (3, 30), (5, 55)}),
])
def test_merge_clauses(spark, changes, expected):
    target, feed = literal(spark, changes)
    assert as_set(merge_changes(target, feed, "k", T2), "k", "v") == expected


def test_net_first_turns_a_reload_into_updates_and_drops_null_keys(spark):
    target, feed = literal(spark, [
        (1, 10, "DELETE", False, 0), (1, 11, "INSERT", False, 1),
        (2, 20, "DELETE", False, 0), (2, 20, "INSERT", False, 1),
        (None, 9, "INSERT", False, 1),
    ], with_seq=True)
    net = net_changes(feed, "k")
    assert as_set(net) == {(1, 11, "INSERT", True, 1)}
    assert as_set(merge_changes(target, net, "k", T2), "k", "v", "_cdc_action") == {
        (1, 11, "UPDATE"), (2, 20, "INITIAL_LOAD"), (3, 30, "INITIAL_LOAD")}


def test_net_of_longer_chains(spark):
    feed = spark.createDataFrame([
        (1, 1, "INSERT", False, 0), (1, 1, "DELETE", False, 1),                     # came and went
        (2, 1, "DELETE", True, 0), (2, 2, "INSERT", True, 1),
        (2, 2, "DELETE", False, 2),                                                 # changed, then went
        (3, 1, "DELETE", False, 0), (3, 2, "INSERT", False, 1),
        (3, 2, "DELETE", True, 2), (3, 3, "INSERT", True, 3),                       # changed twice
        (4, 1, "INSERT", False, 0), (4, 1, "DELETE", True, 1), (4, 5, "INSERT", True, 2),
    ], FEED + ", _seq long")
    assert as_set(net_changes(feed, "k")) == {
        (2, 1, "DELETE", False, 2), (3, 3, "INSERT", True, 3), (4, 5, "INSERT", False, 2)}


def test_null_values_are_merged(spark):
    target, feed = literal(spark, [(1, None, "INSERT", True)])
    assert as_set(merge_changes(target, feed, "k", T2), "k", "v") == {(1, None), (2, 20), (3, 30)}


def test_repeated_keys_do_not_multiply(spark):
    many = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("v"))
    feed = change_feed(many.filter("v < 1000"), many.filter("v >= 1000"), "k")
    assert feed.count() == 2000
    target = initial_load(many, T1)
    assert merge_changes(target, feed, "k", T2).count() == 2000
    history = scd2_apply(None, many, "k", ["v"], T1)
    assert scd2_apply(history, many, "k", ["v"], T2).count() == 2000


def random_state(rng):
    keys = rng.sample(range(12), rng.randint(0, 9))
    return [(k, f"C{k % 3}", f"2025-0{rng.randint(1, 3)}-01" if rng.random() > .1 else None,
             rng.choice([1.0, 2.0, None]), rng.choice(["completed", "returned", None]), "FR")
            for k in keys]


@pytest.mark.parametrize("seed", range(4))
def test_random_states(spark, seed, tmp_path):
    rng = random.Random(seed)
    old, new = (raw_orders(spark, random_state(rng)) for _ in range(2))
    table = Table(spark, str(tmp_path / "t"), BY_MONTH)
    table.replace(initial_load(old, T1))
    table.merge(change_feed(old, new, KEY), KEY, T2, feed="raw", batch=1)
    assert as_set(table.read().select(*SIX)) == as_set(new)
    history = scd2_apply(scd2_apply(None, old, KEY, TRACKED, T1), new, KEY, TRACKED, T2)
    expected = {(k, a, s) for k, _, _, a, s, _ in as_set(new)}
    assert as_set(state_at(history, T2), "order_id", "amount", "status") == expected
    assert as_set(state_at(history, T1)) == as_set(old)


# -- stored tables and the stream ------------------------------------------------


def test_merge_touches_only_the_slices_of_changed_rows(spark, tmp_path):
    rows = [(i, "C", f"2025-0{m}-10", 1.0, "completed", "FR") for m in (1, 2, 3) for i in (m, m + 10)]
    table = Table(spark, str(tmp_path), BY_MONTH)
    old = raw_orders(spark, rows)
    table.replace(initial_load(old, T1))
    moved = raw_orders(spark, [(1, "C", "2025-04-01", 1.0, "completed", "FR")] + rows[1:2] + rows[4:])
    table.merge(change_feed(old, moved, KEY), KEY, T2, feed="raw", batch=1)
    folders = table.version().folders
    assert folders["2025-03"].startswith("data/v=1/")          # unchanged month, same files
    assert "2025-02" not in folders                            # emptied month is gone
    assert folders["2025-01"].startswith("data/v=2/") and "2025-04" in folders
    assert as_set(table.read().select(*SIX)) == as_set(moved)
    assert as_set(table.read(number=1).select(*SIX)) == as_set(old)


def test_an_unfinished_write_is_invisible(spark, tmp_path):
    table = Table(spark, str(tmp_path), BY_MONTH)
    table.replace(raw_orders(spark, A))
    half = raw_orders(spark, C[:1]).withColumn("slice", F.lit("2025-01"))
    half.write.partitionBy("slice").parquet(f"{tmp_path}/data/v=2")   # broke off before the log
    assert as_set(table.read()) == as_set(raw_orders(spark, A))
    assert table.replace(raw_orders(spark, C)) == 7
    assert as_set(table.read()) == as_set(raw_orders(spark, C))


def test_empty_table(spark, tmp_path):
    table = Table(spark, str(tmp_path), BY_MONTH)
    assert table.version() is None
    with pytest.raises(LookupError):
        table.read()
    assert table.replace(raw_orders(spark, [])) == 0
    assert table.read().count() == 0 and table.read().schema.names == SIX
    table.upsert(raw_orders(spark, A), [KEY])
    assert table.read().count() == 5


def test_stream_merges_each_file_once(spark, tmp_path, states):
    old, new = states
    target = Table(spark, str(tmp_path / "cdc"), BY_MONTH)
    target.replace(initial_load(old, T1))
    feed, offset = str(tmp_path / "feed"), str(tmp_path / "offset")

    def run():
        follow_feed(spark, feed, RAW_ORDERS, target, KEY, offset, lambda batch: T2, files_per_batch=1)

    change_feed(old, new, KEY).coalesce(1).write.parquet(feed)
    run()
    assert as_set(target.read().select(*SIX)) == as_set(new)
    seen = target.version().number
    run()                                                        # no new files, no new version
    assert target.version().number == seen
    change_feed(new, old, KEY, first_seq=10).coalesce(1).write.mode("append").parquet(feed)
    run()
    assert as_set(target.read().select(*SIX)) == as_set(old)
    version = target.version()
    (feed_name, last), = version.batches.items()
    again = change_feed(old, new, KEY)                           # the last batch handed over twice
    assert target.merge(again, KEY, T2, feed=feed_name, batch=last) == 0
    assert target.version().number == version.number
    assert target.merge(again, KEY, T2, feed="another stream", batch=0) == 7


def test_stream_survives_a_failure_after_the_commit(spark, tmp_path, states, monkeypatch):
    old, new = states
    target = Table(spark, str(tmp_path / "cdc"), BY_MONTH)
    target.replace(initial_load(old, T1))
    feed, offset = str(tmp_path / "feed"), str(tmp_path / "offset")
    change_feed(old, new, KEY).coalesce(1).write.parquet(feed)
    commit = Table.merge

    def breaks(self, *args, **kwargs):
        commit(self, *args, **kwargs)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(Table, "merge", breaks)
    with pytest.raises(Exception):
        follow_feed(spark, feed, RAW_ORDERS, target, KEY, offset, lambda batch: T2)
    monkeypatch.setattr(Table, "merge", commit)
    number = target.version().number
    follow_feed(spark, feed, RAW_ORDERS, target, KEY, offset, lambda batch: T2)
    assert target.version().number == number
    assert as_set(target.read().select(*SIX)) == as_set(new)


# -- history -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def history(spark, states, tmp_path_factory):
    table = Table(spark, str(tmp_path_factory.mktemp("history")), BY_VALIDITY)
    table.remember(states[0], KEY, TRACKED, T1)
    table.remember(states[1], KEY, TRACKED, T2)
    return table


def test_versions(history):
    found = as_set(history.read().select(
        "order_id", "amount", "status",
        F.col("valid_from").cast("string"), F.col("valid_to").cast("string")))
    assert found == {
        (1, 120.5, "completed", T1, T2), (1, 120.5, "returned", T2, None),
        (2, 80.0, "completed", T1, T2), (2, 90.0, "completed", T2, None),
        (3, 40.0, "cancelled", T1, None), (4, 220.0, "completed", T1, None),
        (5, 150.0, "completed", T1, T2), (6, 30.0, "completed", T2, None),
        (7, 10.0, "completed", T2, None), (8, 280.0, "completed", T2, None)}
    assert set(history.version().folders) == {"open-2025-01", "closed-2025-01"}


def test_state_at(history, states):
    old, new = states
    assert as_set(state_at(history.read(), T1)) == as_set(old)
    assert as_set(state_at(history.read(), "2025-01-06 23:59:59")) == as_set(old)
    assert as_set(state_at(history.read(), T2)) == as_set(new)
    assert state_at(history.read(), "2025-01-05 00:00:00").count() == 0


def test_stored_history_rewrites_only_touched_months(spark, tmp_path):
    rows = [(m * 10 + i, "C", f"2025-0{m}-10", 1.0, "pending", "FR") for m in (1, 2, 3) for i in (1, 2)]
    table = Table(spark, str(tmp_path), BY_VALIDITY)
    table.remember(raw_orders(spark, rows), KEY, TRACKED, "2025-04-01 00:00:00")
    done = [(*r[:4], "completed", r[5]) if r[0] == 21 else r for r in rows if r[0] != 31]
    table.remember(raw_orders(spark, done), KEY, TRACKED, "2025-05-01 00:00:00")
    folders = table.version().folders
    assert {s: f.split("/")[1] for s, f in folders.items()} == {
        "open-2025-01": "v=1", "open-2025-02": "v=2", "open-2025-03": "v=2", "closed-2025-05": "v=2"}
    final = [r for r in done if r[0] != 12]
    table.remember(raw_orders(spark, final), KEY, TRACKED, "2025-06-01 00:00:00")
    assert table.version().folders["closed-2025-05"] == folders["closed-2025-05"]
    for moment, state in [("2025-04-15", rows), ("2025-05-01", done), ("2025-06-02", final)]:
        moment = dt.datetime.fromisoformat(moment)
        assert as_set(orders_at(table, moment)) == as_set(raw_orders(spark, state))
    read = {f.split("slice=")[1].split("/")[0] for f in table.read_valid(dt.datetime(2025, 5, 20)).inputFiles()}
    assert "closed-2025-05" in read and "closed-2025-06" in read
    read = {f.split("slice=")[1].split("/")[0] for f in table.read_valid(dt.datetime(2025, 6, 1)).inputFiles()}
    assert "closed-2025-05" not in read


def test_same_source_again_makes_no_version(history, states):
    before = as_set(history.read())
    history.remember(states[1], KEY, TRACKED, "2025-02-07 00:00:00")
    assert as_set(history.read()) == before


def test_untracked_change_makes_no_version(spark, states):
    first = scd2_apply(None, states[0], KEY, TRACKED, T1)
    moved = states[0].withColumn("country", F.lit("XX"))
    assert as_set(scd2_apply(first, moved, KEY, TRACKED, T2)) == as_set(first)


def test_returning_key_opens_a_version(spark, states):
    old = states[0]
    first = scd2_apply(None, old, KEY, TRACKED, T1)
    second = scd2_apply(first, old.filter("order_id <> 3"), KEY, TRACKED, T2)
    third = scd2_apply(second, old, KEY, TRACKED, "2025-01-08 00:00:00")
    spans = as_set(third.filter("order_id = 3").select(
        F.col("valid_from").cast("string"), F.col("valid_to").cast("string")))
    assert spans == {(T1, T2), ("2025-01-08 00:00:00", None)}


def test_null_values_are_compared_and_null_keys_left_out(spark):
    rows = [(1, "C", "2025-01-01", None, None, "FR"), (None, "C", "2025-01-01", 1.0, "completed", "FR")]
    source = raw_orders(spark, rows)
    first = scd2_apply(None, source, KEY, TRACKED, T1)
    assert first.count() == 1
    assert scd2_apply(first, source, KEY, TRACKED, T2).count() == 1


# -- copies, several feeds, unknown bases ---------------------------------------------


def orders(spark, *rows):
    """Orders from (id, amount); all else is equal."""
    return raw_orders(spark, [(i, "C", "2025-01-01", a, "completed", "FR") for i, a in rows])


def events(feed):
    return sorted((r.order_id, r.amount, r._action, r._is_update) for r in feed.collect())


def test_feed_counts_copies(spark):
    one, two = orders(spark, (1, 5.0)), orders(spark, (1, 5.0), (1, 5.0))
    assert events(change_feed(one, two, KEY)) == [(1, 5.0, "INSERT", False)]
    assert events(change_feed(two, one, KEY)) == [(1, 5.0, "DELETE", True)]
    new = orders(spark, (1, 5.0), (2, 7.0), (2, 7.0))
    feed = change_feed(one, new, KEY)
    assert events(feed) == [(2, 7.0, "INSERT", False)] * 2
    target = initial_load(one, T1)
    merged = merge_changes(target, net_changes(feed, KEY), KEY, T2)
    assert sorted((r.order_id, r.amount) for r in merged.collect()) == [(1, 5.0), (2, 7.0), (2, 7.0)]


def test_losing_one_of_several_rows_deletes_nothing(spark):
    old, new = orders(spark, (1, 5.0), (1, 6.0), (2, 1.0)), orders(spark, (1, 5.0))
    feed = change_feed(old, new, KEY)
    assert events(feed) == [(1, 6.0, "DELETE", True), (2, 1.0, "DELETE", False)]
    assert events(net_changes(feed, KEY)) == [(2, 1.0, "DELETE", False)]


def test_net_effect_does_not_depend_on_numbering(spark):
    a, b, c = (orders(spark, (1, x), (2, y)) for x, y in ((10.0, 1.0), (20.0, 2.0), (5.0, 1.0)))
    feeds = [change_feed(a, b, KEY), change_feed(b, c, KEY)]
    for pair in (feeds, feeds[::-1]):
        net = net_changes(pair[0].unionByName(pair[1]), KEY)
        assert events(net) == [(1, 5.0, "INSERT", True)]


def test_two_feeds_waiting_for_one_stream_run(spark, tmp_path):
    a, b, c = (orders(spark, (1, x), (2, 1.0)) for x in (10.0, 20.0, 5.0))
    target = Table(spark, str(tmp_path / "t"), BY_MONTH)
    target.replace(initial_load(a, T1))
    for old, new in ((a, b), (b, c)):
        change_feed(old, new, KEY).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    follow_feed(spark, str(tmp_path / "feed"), RAW_ORDERS, target, KEY, str(tmp_path / "o"), lambda n: T2)
    assert as_set(target.read(), "order_id", "amount") == {(1, 5.0), (2, 1.0)}


def test_daily_run_and_stream_take_turns(spark, tmp_path):
    raw, merged = (Table(spark, str(tmp_path / n), BY_MONTH) for n in ("raw", "merged"))
    raw.replace(orders(spark, (1, 1.0)))
    refresh_cdc(raw, merged, T1)
    extra = change_feed(orders(spark, (1, 1.0)), orders(spark, (1, 1.0), (3, 3.0)), KEY)
    assert merged.merge(extra, KEY, T2, feed="stream", batch=2) > 0
    raw.replace(orders(spark, (1, 1.0), (2, 2.0), (3, 3.0)))
    refresh_cdc(raw, merged, T2)
    assert as_set(merged.read(), "order_id", "amount") == {(1, 1.0), (2, 2.0), (3, 3.0)}
    assert merged.merge(extra, KEY, T2, feed="stream", batch=2) == 0
    assert refresh_cdc(raw, merged, T2) == 0


def test_merged_table_of_unknown_origin_is_compared_with_raw(spark, tmp_path):
    raw, merged = (Table(spark, str(tmp_path / n), BY_MONTH) for n in ("raw", "merged"))
    raw.replace(orders(spark, (1, 1.0), (2, 2.0)))
    merged.replace(initial_load(orders(spark, (1, 1.0), (9, 9.0)), T1))
    refresh_cdc(raw, merged, T2)
    assert as_set(merged.read(), "order_id", "amount", "_cdc_action") == {
        (1, 1.0, "INITIAL_LOAD"), (2, 2.0, "INSERT")}


def test_history_refuses_a_backdated_run(spark, tmp_path):
    table = Table(spark, str(tmp_path), BY_VALIDITY)
    table.remember(orders(spark, (1, 1.0)), KEY, TRACKED, T2)
    with pytest.raises(ValueError, match="after"):
        table.remember(orders(spark, (1, 2.0)), KEY, TRACKED, T1)


def history_rows(table):
    columns = [*SIX, "valid_from", "valid_to"]
    return sorted((str(tuple(r)) for r in table.read().select(*columns).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_history_from_changed_months_equals_history_from_all(spark, seed, tmp_path):
    """Also where an order's day moves without a version, keys repeat, or rows come back."""
    rng = random.Random(100 + seed)

    def state():
        rows = [(rng.randint(0, 14), f"C{rng.randint(0, 2)}", f"2025-0{rng.randint(1, 4)}-01" if rng.random() > .1 else None,
                 rng.choice([1.0, 2.0, None]), rng.choice(["completed", "returned"]), "FR") for _ in range(14)]
        return rows + [(None, "N", "2025-01-01", 1.0, "x", "FR")]

    raw = Table(spark, f"{tmp_path}/raw", BY_MONTH, key=KEY, prints=True)
    pruned = Table(spark, f"{tmp_path}/pruned", BY_VALIDITY, key=KEY)
    whole = Table(spark, f"{tmp_path}/whole", BY_VALIDITY)
    rows = state()
    for run in range(4):
        at = f"2025-06-0{run + 1} 00:00:00"
        raw.replace(raw_orders(spark, rows))
        refresh_history(raw, pruned, at)
        whole.remember(raw.read(), KEY, TRACKED, at)
        assert history_rows(pruned) == history_rows(whole)
        assert pruned.source_seen() == raw.version().number
        changed, fresh = rng.sample(range(len(rows)), 3), state()
        rows = [fresh[i] if i in changed[:2] else r for i, r in enumerate(rows)]
        moved = rows[changed[2]]
        rows[changed[2]] = (*moved[:2], "2025-03-01", *moved[3:])


def test_history_reads_changed_months_only(spark, tmp_path, monkeypatch):
    rows = [(100 * m + i, "C", f"2025-0{m}-10", 1.0, "pending", "FR") for m in (1, 2, 3, 4) for i in (1, 2)]
    raw = Table(spark, f"{tmp_path}/raw", BY_MONTH, key=KEY, prints=True)
    table = Table(spark, f"{tmp_path}/history", BY_VALIDITY, key=KEY)
    raw.replace(raw_orders(spark, rows))
    refresh_history(raw, table, "2025-05-01 00:00:00")
    raw.replace(raw_orders(spark, [(*r[:4], "completed", r[5]) if r[0] == 201 else r for r in rows]))
    read, seen = Table._read, []
    monkeypatch.setattr(Table, "_read", lambda self, version, slices=None: seen.append(
        (self.root.split("/")[-1], version.folders.keys() if slices is None else set(slices))) or read(self, version, slices))
    assert refresh_history(raw, table, "2025-05-02 00:00:00") == 3
    assert {s for name, slices in seen for s in slices if name == "raw"} == {"2025-02"}
    assert {s for name, slices in seen for s in slices if name == "history"} == {"open-2025-02", "closed-2025-05"}
    # A new raw version without changes writes nothing, but is noted.
    raw.replace(raw_orders(spark, [(*r[:4], "completed", r[5]) if r[0] == 201 else r for r in rows][::-1]))
    folders = table.version().folders
    assert refresh_history(raw, table, "2025-05-03 00:00:00") == 0
    assert table.source_seen() == 3 and table.version().folders == folders
    # A run by hand ends that; the next run compares everything again.
    table.remember(raw_orders(spark, rows), KEY, TRACKED, "2025-05-04 00:00:00")
    assert table.source_seen() is None
    refresh_history(raw, table, "2025-05-05 00:00:00")
    assert table.read().filter("valid_to IS NULL AND status = 'completed'").count() == 1
