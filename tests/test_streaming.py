"""Live queries with ordered state, subscriptions and nested patches."""

import datetime
import json
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from recordspark.streaming import feeds, patches
from recordspark.streaming.subscriptions import Subscription

FORM = "id long, name string, at int, gone boolean"


def told_of(spark, tmp_path, batches, form=FORM, **kw):
    """The notifications of batches that come one after the other, each from a new start of the query."""
    got = []
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, form).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        told = feeds.notifications(feeds.stream(spark, str(tmp_path / "in"), form), "id", "at", "gone", **kw)
        q = feeds.live(told, lambda df, _: got.extend((r["key"], r["action"], json.loads(r["result"])["name"]) for r in df.collect()), str(tmp_path / "c"), once=True)
        q.awaitTermination(60)
        assert q.exception() is None
    return got


def test_older_versions_of_later_batches_are_left_out(spark, tmp_path):
    got = told_of(spark, tmp_path, [[(1, "new", 5, False), (2, "b", 5, False)], [(1, "old", 3, False), (2, "gone", 4, True)], [(2, "x", 6, True), (1, "none", None, False)], [(2, "late", 5, False), (1, "next", 7, None)]])
    assert sorted(got) == sorted([("1", "CREATE", "new"), ("2", "CREATE", "b"), ("2", "DELETE", "b"), ("1", "UPDATE", "next")])


def test_shuffled_batches_are_told_in_order(spark, tmp_path):
    form, rng = "id long, name string, at timestamp, gone boolean", random.Random(5)
    start = 1_700_000_000
    versions = [(k, f"v{i}", i * 10 + k, i == 6) for k in range(3) for i in range(9)]
    want = [(str(k), "CREATE" if i in (0, 7) else "DELETE" if i == 6 else "UPDATE", f"v{i - (i == 6)}") for k in range(3) for i in range(9)]
    rng.shuffle(versions)
    rows = [(k, n, start + at, gone) for k, n, at, gone in versions]
    batches = [rows[i : i + 9] for i in range(0, 27, 9)] + [[(99, "end", start + 10_000, False)], [(99, "end", start + 20_000, False)]]
    frames = [[(k, n, datetime.datetime.fromtimestamp(t), g) for k, n, t, g in b] for b in batches]
    got = told_of(spark, tmp_path, frames, form, late="200 seconds", keep=600)
    got = [g for g in got if g[0] != "99"]
    assert sorted(got) == sorted(want)
    for k in "012":
        assert [g for g in got if g[0] == k] == [w for w in want if w[0] == k]


@pytest.fixture
def growing(spark, tmp_path):
    def add(*ids):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    add(1, 2, 3)
    return add, lambda: feeds.stream(spark, str(tmp_path / "in"), "id long", 1).select(F.lit("CREATE").alias("action"), "id"), str(tmp_path / "c")


def test_subscriptions(growing):
    add, rows, checkpoint = growing
    add(4, 5)
    heard, s = [], Subscription(rows(), checkpoint, once=True)
    s.on(heard.append)
    s.on(lambda n: 1 / 0)
    end = s.on(lambda n: heard.append("twice"))
    end()
    assert sorted(n["id"] for n in s) == [1, 2, 3, 4, 5]
    assert [h["action"] for h in heard] == ["CREATE"] * 5 + ["CLOSE"] and len(s.errors) == 6 and not s.active
    with pytest.raises(ValueError):
        Subscription(rows(), checkpoint, size=0)


def test_slow_readers_hold_the_stream_and_lose_nothing(growing):
    add, rows, checkpoint = growing
    add(4, 5)
    s = Subscription(rows(), checkpoint, size=1)
    it, seen = iter(s), []
    seen.append(next(it))
    time.sleep(3)
    assert s.query.lastProgress is None or s.query.lastProgress["batchId"] == 0  # the first batch isn't over
    s.close()
    again = Subscription(rows(), checkpoint, size=1, once=True)
    seen += list(again)
    assert {n["id"] for n in seen} == {1, 2, 3, 4, 5} and len({(n["batch"], n["place"]) for n in seen}) == 5


def test_closing_ends_a_waiting_reader(growing):
    _, rows, checkpoint = growing
    s, heard = Subscription(rows(), checkpoint), []
    s.on(heard.append)
    threading.Timer(8, s.close).start()
    assert s.run() == 3 and heard[-1]["action"] == "CLOSE"


NESTED = "id long, a int, `x/y` string, s struct<p: int, q: struct<r: array<int>, t: string>>, m map<string, struct<u: int>>, l array<struct<w: int, z: array<string>>>"


def random_rows(rng, n):
    some = lambda f: None if rng.random() < 0.2 else f()
    word = lambda: rng.choice(["", "a", "b~c", "d/e", '"q"', "ü"])
    numbers = lambda: [some(lambda: rng.randrange(3)) for _ in range(rng.randrange(4))]
    inner = lambda: (some(lambda: rng.randrange(3)), some(lambda: (some(numbers), some(word))))
    item = lambda: (some(lambda: rng.randrange(3)), some(lambda: [some(word) for _ in range(rng.randrange(3))]))
    return [(i, some(lambda: rng.randrange(3)), some(word), some(inner), some(lambda: {word(): some(lambda: (some(lambda: rng.randrange(3)),)) for _ in range(rng.randrange(4))}), some(lambda: [some(item) for _ in range(rng.randrange(4))])) for i in range(n)]


def test_patches_lead_from_old_rows_to_new(spark):
    rng = random.Random(9)
    old, new = (spark.createDataFrame(random_rows(rng, 200), NESTED) for _ in range(2))
    found = patches.patches(old, new, "id")
    got = {r["id"]: r for r in patches.patched(old, found, "id").collect()}
    want = {r["id"]: r for r in new.collect()}
    assert len(got) == 200 and got == want
    assert patches.patches(old, old, "id").count() == 0 and found.count() > 150


def test_paths_of_patches(spark):
    form = "id long, s struct<p: int, r: array<int>>, m map<string, int>"
    old = spark.createDataFrame([(1, (1, [1, 2, 3]), {"a/b": 1, "c": 2}), (2, None, None), (None, None, {})], form)
    new = spark.createDataFrame([(1, (2, [1, 5]), {"a/b": 3, "d": None}), (2, (1, []), {}), (None, None, None)], form)
    got = {r["id"]: [tuple(c) for c in r["changes"]] for r in patches.patches(old, new, "id").collect()}
    assert got[1] == [("replace", "/s/p", "2"), ("replace", "/s/r/1", "5"), ("remove", "/s/r/2", None), ("replace", "/m/a~1b", "3"), ("remove", "/m/c", None), ("add", "/m/d", "null")]
    assert got[2] == [("add", "/s", '{"p":1,"r":[]}'), ("add", "/m", "{}")] and set(got) == {1, 2}
    more = patches.patches(old.select("id"), new, "id").count()
    assert more == 2
    with pytest.raises(ValueError):
        patches.patches(old, new.withColumn("s", F.lit(1)), "id")


def test_patches_of_notifications(spark):
    told = spark.createDataFrame([("1", "UPDATE", '{"a":{"b":[1,3]}}', '{"a":{"b":[1,2]},"c":"x"}'), ("2", "CREATE", '{"c":"y"}', None), ("3", "DELETE", '{"c":"y"}', '{"c":"y"}')], "key string, action string, result string, before string")
    form = spark.createDataFrame([], "a struct<b: array<int>>, c string").schema
    got = {r["key"]: r["patch"] for r in feeds.with_patches(told, form).collect()}
    assert [tuple(p) for p in got["1"]] == [("replace", "/a/b/1", "3"), ("remove", "/c", None)] and got["2"] is None and got["3"] is None


def test_snapshot_changes_of_nulls_zeros_and_repeats(spark, tmp_path):
    """What the SQL of snapshot_null_keys says, with balances that are null or -0.0 and with repeated keys."""
    rows = [(1, 5.0), (2, None), (3, -0.0), (4, -7.0), (5, 9.0), (6, 3.0), (6, 3.0), (7, 2.0), (7, -1.0), (8, 4.0), (8, 0.0), (9, float("nan")), (None, 1.0)]
    _same_as_sql(spark, tmp_path, "snapshot_null_keys", "customer", rows, "c_custkey long, c_acctbal double")


def test_live_notifications_of_nulls_and_wide_keys(spark, tmp_path):
    """What the SQL of live_notifications says, with nulls in every column and event numbers that reach over years."""
    year, kinds, rng = 366 * 86_400_000, ["view", "click", "error", None], random.Random(3)
    rows = [(i * year // 40 + i % 2, rng.choice([1, 2, 3, None]), rng.choice(kinds)) for i in range(200)] + [(None, 1, "last"), (None, 2, None), (-3, 1, "view"), (-2, 1, "error")]
    _same_as_sql(spark, tmp_path, "live_notifications", "events", rows, "event_id long, user_id long, event_type string")


def _same_as_sql(spark, tmp_path, name, table, rows, form):
    import duckdb

    from recordspark.registry import ORACLE_SQL, QUERIES

    spark.createDataFrame(rows, form).coalesce(2).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = [tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(con.sql(ORACLE_SQL[name]).fetchall(), key=repr)
