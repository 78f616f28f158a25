"""Enforced schemas, events, objects, snapshots and version graphs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from recordspark.operators import enforced, versions
from recordspark.sources import schema as sc
from recordspark.sources import snapshots
from recordspark.sources.catalog import Catalog


def reasons(c):
    return sorted(((r["id"], [(v["field"], v["kind"]) for v in r["violations"]]) for r in c.rejected.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_checks_of_new_rows(spark):
    there = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "id long, mail string, owner long")
    owners = spark.createDataFrame([(1,), (2,)], "key long")
    s = sc.TableSchema("t", (sc.Field("mail", "string", assertion="length(mail) < 5"), sc.record_field("owner", "owners"), sc.Field("size", "int", default=3)), (sc.Index("m", ("mail",), unique=True),), full=True)
    new = [{"id": 1, "mail": "x", "owner": None}, {"id": 3, "mail": "a", "owner": 9}, {"id": 4, "mail": "n", "owner": 2}, {"id": 5, "mail": "n", "owner": 1}, {"id": 6, "mail": None, "owner": 1}, {"id": 7, "mail": None, "owner": None}, {"id": 8, "mail": "too long", "owner": 1}, {"id": None, "mail": "y", "owner": 1}, {"id": 9, "mail": "z", "owner": 1}, {"id": 9, "mail": "zz", "owner": 1}]
    done = enforced.insert(there, new, "id", s, {"owners": (owners, "key")})
    assert reasons(done) == [(1, [("id", "exists")]), (3, [("mail", "unique"), ("owner", "reference")]), (5, [("mail", "unique")]), (8, [("mail", "assert")]), (9, [("id", "exists")]), (None, [("id", "null")])]
    assert sorted(r["id"] for r in done.result.collect()) == [4, 6, 7, 9] and done.state.count() == 6 and {r["size"] for r in done.result.collect()} == {3}
    # a row that replaces another frees its values
    swapped = enforced.upsert(there, [{"id": 1, "mail": "b"}, {"id": 2, "mail": "a"}], "id", s)
    assert swapped.rejected.count() == 0 and {(r["id"], r["mail"]) for r in swapped.state.collect()} == {(1, "b"), (2, "a")}
    taken = enforced.upsert(there, [{"id": 1, "mail": "b"}], "id", s)
    assert reasons(taken) == [(1, [("mail", "unique")])] and sorted(r["mail"] for r in taken.state.collect()) == ["a", "b"]
    more = enforced.insert(there, [{"id": 20, "mail": "q", "other": 1}, {"id": 21, "mail": "r", "other": None}], "id", s)
    assert reasons(more) == [(20, [("other", "undeclared")])]
    assert enforced.insert(there, there.limit(0), "id", s).state.count() == 2
    same = enforced.insert(there, [{"id": 30, "mail": "s"}] * 4, "id", s)
    assert same.result.count() == 1 and same.rejected.count() == 3


def test_permissions_of_mutations_and_of_edges(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 50), (3, "c", None)], "id long, kind string, n int")
    s = sc.TableSchema("t", (sc.Field("n", "int", assertion="n < 60"), sc.Field("kind", "string", readonly=True)), permissions=(("update", "kind <> 'a'"), ("delete", "n > 10"), ("create", "kind = 'new'"), ("select", "n is not null")))
    done = enforced.update(rows, {"n": F.col("n") + 20}, "id", s)
    assert {(r["id"], r["n"]) for r in done.state.collect()} == {(1, 5), (2, 50), (3, None)} and reasons(done) == [(2, [("n", "assert")])]
    with pytest.raises(ValueError):
        enforced.update(rows, {"kind": "x"}, "id", s)
    assert sorted(r["id"] for r in enforced.delete(rows, s).state.collect()) == [1, 3]
    assert reasons(enforced.insert(rows, [{"id": 9, "kind": "old"}, {"id": 8, "kind": "new"}], "id", s)) == [(9, [("", "permission")])]
    edges = spark.createDataFrame([(1, 2, "x")], "`in` long, out long, why string")
    e = sc.EdgeSchema("e", (sc.Field("why", "string", nullable=False),), permissions=(("select", "why <> 'x'"),), from_table="t", to_table="t")
    found = enforced.relate(edges, [(1, 3, {"why": None}), (1, 9, {"why": "y"}), (2, 3, {"why": "z"}), (7, 8, {"why": "w"})], e, {"t": (rows, "id")})
    assert sorted((r["in"], [tuple(v) for v in r["violations"]]) for r in found.rejected.collect()) == [(1, [("out", "reference")]), (1, [("why", "null")]), (7, [("in", "reference"), ("out", "reference")])]
    c = Catalog(spark).add("t", rows).add_edge("e", found.state, "t", "t").add_schema(s).add_schema(e)
    assert c.frame("t").count() == 2 and c.frame("e").count() == 1 and c.keys()["t"][0].count() == 3
    with pytest.raises(KeyError):
        c.add_schema(sc.TableSchema("none"))


def test_record_ids_of_other_tables(spark):
    owners = spark.createDataFrame([("a",), ("b c",)], "key string")
    s = sc.TableSchema("t", (sc.record_field("owner", "owners"),))
    rows = spark.createDataFrame([(1, "owners:a"), (2, "owners:<b c>"), (3, "people:a"), (4, "a"), (5, None), (6, "owners:x")], "id long, owner string")
    got = reasons(enforced.check(rows, s, "id", tables={"owners": (owners, "key")}))
    assert got == [(3, [("owner", "reference"), ("owner", "table")]), (6, [("owner", "reference")])]


def test_events_fire(spark):
    before = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (None, 1)], "id long, n int")
    after = spark.createDataFrame([(1, 5), (2, 9), (4, None)], "id long, n int")
    s = sc.TableSchema("t").with_events(sc.Event("grown", "action = 'UPDATE' and after.n > before.n"), sc.Event("any")).with_mode(True)
    assert sorted((r["event"], r["key"], r["action"]) for r in s.fired(before, after, "id").collect()) == [("any", 2, "UPDATE"), ("any", 3, "DELETE"), ("any", 4, "CREATE"), ("grown", 2, "UPDATE")] and s.full
    with pytest.raises(ValueError):
        sc.TableSchema("t").fired(before, after, "id")


def test_objects(spark):
    s = sc.TableSchema("t", (sc.Field("o", "object"), sc.Field("o.n", "int", assertion="o.n > 0"), sc.Field("o.in", "object"), sc.Field("o.in.tags", "array", element="string")))
    rows = spark.createDataFrame([(1, '{"n": 1, "in": {"tags": ["a", null]}}'), (2, '{"n": "x"}'), (3, "{bad"), (4, None), (5, '{"n": null, "in": 3}'), (6, '{"n": -1}'), (7, "[1]")], "id long, o string")
    got = {r["id"]: r["o"] for r in s.opened(rows).collect()}
    assert got[1]["n"] == 1 and got[1]["in"]["tags"] == ["a", None] and got[2]["n"] is None and got[3] is None and got[4] is None and got[7]["n"] is None
    assert [(r["id"], r["field"]) for r in s.mistyped(rows, "id").collect()] == [(2, "o.n")]
    assert [(r["id"], r["field"]) for r in s.violations(s.opened(rows), "id").collect()] == [(6, "o.n")]
    assert [f.name for f in s.spark()] == ["o"]
    as_struct = rows.select("id", F.from_json("o", "n int").alias("o"))
    assert s.opened(as_struct).where("o.n = 1").count() == 1


def test_snapshots_round_trip():
    full = [
        sc.TableSchema("a", (sc.Field("x", "int", assertion="x > 0", default=3, nullable=False), sc.computed_field("y", "x + 1", "int"), sc.record_field("z", "b"), sc.Field("l", "array", element="float")), (sc.Index("i", ("x", "y"), unique=True), sc.search_index("s", "x"), sc.vector_index("v", "l", 4)), rule="x > 1", permissions=(("select", "x > 2"),), full=True, events=(sc.Event("e", "action = 'CREATE'"),)),
        sc.EdgeSchema("e", (sc.Field("w", "string"),), from_table="a", to_table="b"),
    ]
    assert sorted(snapshots.from_json(snapshots.to_json(full)), key=lambda s: s.name) == full
    turned = [full[1], sc.TableSchema(**{**vars(full[0]), "fields": full[0].fields[::-1], "indexes": full[0].indexes[::-1]})]
    assert snapshots.digest(turned) == snapshots.digest(full) != snapshots.digest(full[:1])


def test_compared_snapshots_and_costs_of_going_back(spark):
    one = [sc.TableSchema("t", (sc.Field("a", "string"),))]
    two = [sc.TableSchema("t", (sc.Field("a", "int"), sc.Field("b", "int"))), sc.TableSchema("u")]
    held = snapshots.snapshot(spark, "1", one).union(snapshots.snapshot(spark, "2", two)).union(snapshots.snapshot(spark, "3", two))
    assert {(c.op, c.name) for c in snapshots.compared(held, "1", "2")} == {("add_table", "u"), ("add_field", "b"), ("modify_field", "a")} and snapshots.compared(held, "2", "3") == []
    with pytest.raises(ValueError):
        snapshots.compared(held, "1", "9")
    t = spark.createDataFrame([(1, 5), (None, None), (2, None)], "a long, b long")
    cost = lambda now, then, **rows: {(c.op, c.name): (c.lost, c.broken, c.verdict) for c in snapshots.going_back(now, then, rows)}
    assert cost(two, one, t=t, u=t) == {("drop_table", "u"): (3, 0, "DATA_LOSS"), ("drop_field", "b"): (1, 0, "DATA_LOSS"), ("modify_field", "a"): (0, 0, "SAFE")}
    assert cost(two, one, t=t.limit(0), u=t.limit(0)) == {("drop_table", "u"): (0, 0, "SAFE"), ("drop_field", "b"): (0, 0, "SAFE"), ("modify_field", "a"): (0, 0, "SAFE")}
    assert cost(one, two, t=spark.createDataFrame([("x",), ("3",)], "a string"))["add_table", "u"][2] == "UNSAFE"
    strict = [sc.TableSchema("t", (sc.Field("a", "int", nullable=False),))]
    assert cost(one, strict, t=spark.createDataFrame([("x",), ("3",), (None,)], "a string")) == {("modify_field", "a"): (1, 2, "UNSAFE")}


def test_version_graphs(spark):
    for seed in (1, 2):
        rng = random.Random(seed)
        parents = {v: sorted(rng.sample(range(v), min(v, rng.choice([0, 1, 1, 2, 3])))) for v in range(30)}
        rows = [(v, p) for v, ps in parents.items() for p in ps or [None]]
        g = versions.graph(spark.createDataFrame(rows + rows[:5], "version long, parent long"))
        children = {v: [w for w, ps in parents.items() if v in ps] for v in parents}

        def reach(start, step):
            seen, now, d = {start: 0}, [start], 0
            while now:
                d += 1
                now = sorted({w for v in now for w in step[v]} - set(seen))
                seen |= {w: d for w in now}
            return seen

        up, down = reach(29, parents), reach(0, children)
        pairs = lambda df: {r["version"]: r["distance"] for r in df.collect()}
        assert pairs(g.ancestors(29)) == {k: d for k, d in up.items() if d} and pairs(g.descendants(0)) == {k: d for k, d in down.items() if d}
        assert {r[0] for r in g.heads().collect()} == {v for v in parents if not children[v]} and {r[0] for r in g.roots().collect()} == {v for v in parents if not parents[v]}
        both = {v: parents[v] + children[v] for v in parents}
        for a, b in itertools.islice(itertools.product(range(0, 30, 7), range(1, 30, 9)), 6):
            way = [r["version"] for r in g.path(a, b).orderBy("step").collect()]
            far = reach(a, both).get(b)
            assert (way == []) == (far is None) and (far is None or (len(way) == far + 1 and way[0] == a and way[-1] == b and all(w in both[v] for v, w in zip(way, way[1:]))))
        common = set(up) & set(reach(28, parents))
        if common:
            level = {}
            for v in range(30):
                level[v] = max((level[p] + 1 for p in parents[v]), default=0)
            top = max(level[v] for v in common)
            assert {r["version"] for r in g.common([29, 28]).collect()} == {v for v in common if level[v] == top}
    with pytest.raises(ValueError):
        versions.graph(spark.createDataFrame([(1, None), (2, 1), (3, 2), (2, 3)], "version long, parent long"))
    empty = versions.graph(spark.createDataFrame([], "version string, parent string"))
    assert empty.heads().count() == 0 and empty.path("a", "b").count() == 0


def test_kinds_of_fields_against_rows(spark):
    kinds = list(sc.SPARK_TYPES)
    s = sc.TableSchema("t", tuple(sc.Field(f"f_{k}", k) for k in kinds) + (sc.Field("many", "array", element="datetime"), sc.Field("absent", "bool")))
    rows = spark.createDataFrame([], sc.TableSchema("t", s.fields[:-1]).spark())
    assert sc.mismatches(s, rows) == [("error", "absent", "missing")]
    other = rows.withColumns({"f_bool": F.lit(1), "f_datetime": F.lit("now"), "more": F.lit(1)})
    assert sc.mismatches(s, other) == [("error", "f_bool", "int instead of boolean"), ("error", "f_datetime", "string instead of timestamp"), ("error", "absent", "missing"), ("warning", "more", "not declared")]
    there = spark.createDataFrame([(1, True, "2024-01-01 00:00:00"), (2, None, None)], "id long, ok boolean, at string").withColumn("at", F.to_timestamp("at"))
    checked = sc.TableSchema("t", (sc.Field("ok", "bool", assertion="ok"), sc.Field("at", "datetime", assertion="at > timestamp'2024-06-01'", nullable=False)))
    assert sorted((r["id"], r["field"], r["kind"]) for r in checked.violations(there, "id").collect()) == [(1, "at", "assert"), (2, "at", "null")]
