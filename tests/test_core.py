"""Validation, quirks and behaviour that SQL can't show."""

from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from recordspark.functions import predicates as P
from recordspark.functions import scalar as S
from recordspark.functions import vectors
from recordspark.operators import graph, mutate, records
from recordspark.operators.aggregate import aggregate_records
from recordspark.plans import hints
from recordspark.plans.query import Query
from recordspark.sources import schema as sc
from recordspark.sources.cache import Cache, is_cached, key_of
from recordspark.sources.catalog import Catalog
from recordspark.sources.ids import RecordId
from recordspark.streaming import feeds


@pytest.fixture(scope="module")
def people(spark):
    users = spark.createDataFrame([(1, "Ann", 30, ["a", "b"]), (2, "Bo", 25, ["b"]), (3, "Cy", None, []), (4, "Di", 41, ["c"]), (5, "Ed", 19, None)], "id long, name string, age int, tags array<string>")
    posts = spark.createDataFrame([(10, "x", 1), (11, "y", 2), (12, "z", 2)], "id long, title string, author long")
    follows = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (2, 1), (1, 3), (4, 5)], "`in` long, out long")
    likes = spark.createDataFrame([(1, 11), (3, 11), (2, 10)], "`in` long, out long")
    return Catalog(spark).add("user", users).add("post", posts).add_edge("follows", follows, "user", "user").add_edge("likes", likes, "user", "post")


def ids(df, name="id"):
    return sorted(r[name] for r in df.collect())


def test_queries_are_immutable_and_ordered(people):
    q = Query().from_table("user")
    old = q.where(P.gt("age", 20)).order_by("age", "DESC")
    assert q.conditions == () and [r["id"] for r in old.frame(people).collect()] == [4, 1, 2]
    assert [r["name"] for r in old.select("name").limit(1).offset(1).frame(people).collect()] == ["Ann"]


@pytest.mark.parametrize("bad", [lambda: Query().order_by("a", "up"), lambda: Query().limit(-1), lambda: Query().offset(-1), lambda: Query().vector_search("v", []), lambda: Query().vector_search("v", [1.0], 0), lambda: Query().vector_search("v", [1.0], 1, "NOPE"), lambda: RecordId("a b", 1), lambda: RecordId.parse("plain"), lambda: hints.Parallel(33), lambda: hints.Timeout(0), lambda: hints.Fetch("batch"), lambda: S.time_format("t", "%Q"), lambda: S.cast("x", "colour"), lambda: S.string_concat(), lambda: sc.Field("a-b", "int"), lambda: sc.Field("a", "colour"), lambda: vectors.score("v", [1.0], "MAHALANOBIS")])
def test_bad_arguments(bad):
    with pytest.raises(ValueError):
        bad()


def test_unknown_names(people):
    with pytest.raises(KeyError):
        Query().from_table("nothing").frame(people)
    with pytest.raises(ValueError):
        Query().frame(people)
    with pytest.raises(ValueError):
        Query().from_table("user").traverse("->nothing").frame(people)
    with pytest.raises(ValueError):
        Query().from_table("user").traverse("follows").frame(people)


def test_record_ids():
    assert str(RecordId("user", "alice")) == "user:alice" and RecordId.parse("post:123").id == 123
    assert RecordId.parse(str(RecordId("user", "a b"))).id == "a b"


def test_aggregates(people):
    for bad in ({"select": {}}, {"select": {"n": S.count()}}, {"select": {"n": S.count()}, "group_by": ["age"], "group_all": True}):
        with pytest.raises(ValueError):
            aggregate_records(people, "user", **bad)
    empty = aggregate_records(people, "user", {"n": S.count()}, group_all=True, where="age > 1000")
    assert empty.collect()[0]["n"] == 0
    both = Query().from_table("user").select(S.count().alias("n")).group_by("age").group_all()
    assert both.frame(people).count() == 1


def test_contains_follows_the_type(people):
    df = people.frame("user")
    assert ids(df.where(P.contains("tags", "b").on(df))) == [1, 2]
    assert ids(df.where(P.contains_all("name", ["B", "o"]).on(df))) == [2]
    assert ids(df.where(P.contains_any("tags", ["c", "a"]).on(df))) == [1, 4]
    assert ids(df.where(P.ne("age", 30).on(df))) == [2, 4, 5]


def test_graph(people):
    assert ids(graph.mutual(people, 1, "follows")) == [2]
    assert ids(graph.neighbours(people, 1, "follows", 1, "out")) == [2, 3]
    assert ids(graph.neighbours(people, 1, "follows", 9, "both")) == [2, 3, 4, 5]
    assert [r["id"] for r in graph.shortest_path(people, 1, 5, "follows").orderBy("step").collect()] == [1, 3, 4, 5]
    assert [r["id"] for r in graph.shortest_path(people, 2, 2, "follows").collect()] == [2]
    assert graph.shortest_path(people, 5, 1, "follows").count() == 0
    assert graph.shortest_path(people, 1, 5, "follows", 2).count() == 0
    assert ids(Query().from_table("user:1").traverse("->likes->post<-likes<-user").frame(people)) == [1, 3]
    assert ids(Query().from_table("user:3").traverse("->likes->?").frame(people)) == [11]
    assert graph.degree(people, 2, "follows").first()[:] == (1, 2, 3)
    with pytest.raises(ValueError):
        graph.edges_of(people, 1, "follows", "both")
    with pytest.raises(ValueError):
        graph.neighbours(people, 1, "follows", 0)


def test_mutations(people):
    users = people.frame("user")
    m = mutate.update(users, {"age": 1}, "id", P.gt("age", 26), "diff")
    assert sorted((r["id"], r["changes"][0]["op"], r["changes"][0]["value"]) for r in m.result.collect()) == [(1, "replace", "1"), (4, "replace", "1")]
    assert ids(m.state.where("age = 1")) == [1, 4] and m.state.count() == 5
    with pytest.raises(ValueError):
        mutate.insert(users, [{"id": 1, "name": "x"}], "id")
    with pytest.raises(ValueError):
        mutate.insert(users, [{"id": 8, "name": "x"}, {"id": 8, "name": "y"}], "id")
    with pytest.raises(ValueError):
        mutate.update(users, {"name": "x"}, "id", readonly=["name"])
    with pytest.raises(ValueError):
        mutate.update(users, {"name": "x"}, "id", image="odd")
    assert mutate.insert(users, [], "id").state is users
    up = mutate.upsert(users, [{"id": 1, "name": "Zed"}, {"id": 9, "name": "New"}], "id")
    assert up.state.count() == 6 and up.state.where("id = 1").first()["age"] is None
    by = mutate.upsert(users, [{"id": 99, "name": "Bo"}], "id", on=["name"])
    assert ids(by.state) == [1, 3, 4, 5, 99]
    gone = mutate.delete(users, "age > 20")
    assert ids(gone.state) == [3, 5] and ids(gone.result) == [1, 2, 4]
    assert mutate.delete(users).state.count() == 0
    assert mutate.replace(users, "id", 77, {"name": "x"}).state.count() == 5
    t = mutate.Transaction({"user": users})
    t.execute("user", mutate.delete, "id = 1")
    t.cancel()
    assert t.tables["user"] is users
    with pytest.raises(RuntimeError):
        t.commit()


def test_reading(people):
    assert records.get_record(people, "user", 2)["name"] == "Bo" and records.get_record(people, "user", 99) is None
    assert records.exists(people, "user", 2) and records.count_records(people, "user", "age is null") == 1
    p = records.page(people, Query().from_table("user").order_by("id"), 2, 2)
    assert [r["id"] for r in p.items] == [3, 4] and (p.pages, p.has_next, p.has_previous) == (3, True, True)
    assert records.scalar(people.frame("user").where("id = 99"), "age") == 0
    assert records.last(people, "user").first()["id"] == records.first(people, "user").first()["id"]


def test_hints(people):
    q = Query().from_table("user").order_by("id").hint(hints.Parallel(2), hints.Parallel(1), hints.Fetch("batch", 2))
    assert [[r["id"] for r in b] for b in q.fetch(people)] == [[1, 2], [3, 4], [5]]
    assert q.frame(people).rdd.getNumPartitions() == 1
    assert len(list(Query().from_table("user").hint(hints.Fetch("lazy"), hints.Timeout(60)).fetch(people))) == 5
    with pytest.raises(ValueError):
        Query().from_table("user").hint(hints.Index("post", "i")).frame(people)


def test_schemas(people):
    t = sc.TableSchema("user", (sc.Field("id", "int"), sc.Field("age", "int", assertion="age >= 20"), sc.Field("name", "string", nullable=False), sc.Field("status", "string", default="on"), sc.computed_field("twice", "age * 2", "int")))
    df = people.frame("user")
    assert [(r["id"], r["field"]) for r in t.violations(df, "id").collect()] == [(5, "age")]
    done = t.applied(df)
    assert done.where("status = 'on'").count() == 5 and done.where("id = 1").first()["twice"] == 60
    new = sc.TableSchema("user", t.fields[1:]).with_fields(sc.Field("mail", "string"))
    assert {(c.op, c.name, c.safe) for c in sc.differences([t], [new])} == {("add_field", "mail", True), ("drop_field", "id", False)}
    assert {(s, n) for s, n, _ in sc.mismatches(t, df)} == {("error", "age"), ("error", "status"), ("error", "twice"), ("warning", "tags")}


def test_cache(people):
    now = [0.0]
    c = Cache(ttl=10, size=1, clock=lambda: now[0])
    make = lambda: people.frame("user").where("age > 20")
    c.get_or_set(make, "user")
    c.get_or_set(make, "user")
    now[0] = 11
    c.get_or_set(make, "user")
    assert (c.hits, c.misses) == (1, 2) and c.invalidate("post") == 0 and c.invalidate("user") == 1


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:10:00", "a"), (2, "2024-01-01 00:20:00", "b")], "id long, t string, kind string").select("id", F.col("t").cast("timestamp_ntz").alias("t"), "kind")
    rows.write.parquet(str(tmp_path / "in"))
    got = []
    src = feeds.stream(spark, str(tmp_path / "in"))
    q = feeds.live(feeds.created(src, "id", "t"), lambda df, _: got.extend(df.collect()), str(tmp_path / "c1"), once=True)
    q.awaitTermination(60)
    assert sorted(r["result"]["id"] for r in got) == [1, 2] and {r["action"] for r in got} == {"CREATE"}
    kept = []
    feeds.live(src, lambda df, _: kept.extend(df.collect()), str(tmp_path / "c2"), F.col("kind") == "a", once=True).awaitTermination(60)
    assert len(kept) == 2


def test_patches(people):
    old = people.frame("user").select("id", "name", "age")
    new = old.withColumn("age", F.when(F.col("id") == 1, 31).when(F.col("id") == 3, 7).otherwise(F.when(F.col("id") != 2, F.col("age"))))
    got = {r["id"]: [(c["op"], c["path"], c["value"]) for c in r["changes"]] for r in feeds.patches(old, new, "id").collect()}
    assert got == {1: [("replace", "/age", "31")], 2: [("remove", "/age", None)], 3: [("add", "/age", "7")]}


def test_vector_metrics(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],)], "v array<double>")
    q = [2.0, 2.0, 1.0]
    want = {"EUCLIDEAN": 10**0.5, "MANHATTAN": 4, "CHEBYSHEV": 3, "MINKOWSKI": 28 ** (1 / 3), "HAMMING": 2, "JACCARD": 2 / 3, "COSINE": 10 / (21**0.5 * 3)}
    for metric, x in want.items():
        assert df.select(vectors.score("v", q, metric)).first()[0] == pytest.approx(x)
    inverse = [[2.0, 0, 0], [0, 1.0, 0], [0, 0, 0.5]]
    assert df.select(vectors.score("v", q, "MAHALANOBIS", inverse=inverse)).first()[0] == pytest.approx((2 + 4.5) ** 0.5)


def test_notifications_of_updates_and_deletes(spark, tmp_path):
    form = "id long, name string, at int, gone boolean"
    batches = [[(1, "a", 1, False), (2, "b", 2, False)], [(1, "c", 3, None), (2, "b", 4, False), (3, "x", 6, True), (3, "x", 5, False)], [(2, "b", 7, True), (4, "d", 8, True), (3, "y", 9, False)]]
    got = []
    for rows in batches:
        spark.createDataFrame(rows, form).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        told = feeds.notifications(feeds.stream(spark, str(tmp_path / "in"), form), "id", "at", "gone")
        q = feeds.live(told, lambda df, _: got.append(sorted((r["key"], r["action"]) for r in df.collect())), str(tmp_path / "c"), once=True)
        q.awaitTermination(60)
    assert [g for g in got if g] == [[("1", "CREATE"), ("2", "CREATE")], [("1", "UPDATE"), ("3", "CREATE"), ("3", "DELETE")], [("2", "DELETE"), ("3", "CREATE")]]
    gone = []
    told = feeds.notifications(feeds.stream(spark, str(tmp_path / "in"), form), "id", "at", "gone")
    feeds.on_event(told, ["DELETE"], lambda df, _: gone.extend(r["key"] for r in df.collect()), str(tmp_path / "c3"), F.col("key") > "2", once=True).awaitTermination(60)
    assert gone == ["3"]
    with pytest.raises(ValueError):
        feeds.on_event(told, ["DROP"], print, str(tmp_path / "c4"))
    q = feeds.live(feeds.stream(spark, str(tmp_path / "in"), form), lambda df, _: None, str(tmp_path / "c2"))
    assert [x.id for x in feeds.active(spark)] == [q.id]
    assert feeds.kill(spark, str(q.id)) and not feeds.kill(spark, str(q.id)) and feeds.active(spark) == []


def test_query_conditions_of_other_queries(people):
    users = Query().from_table("user")
    ids = lambda q: sorted(r["id"] for r in q.frame(people).collect())
    every = ids(users)
    assert ids(users.bind(n=min(every)).where("id > :n")) == every[1:]
    assert ids(users.where(users.where(P.eq("id", every[0])).select("id").inside(people, "id"))) == every[:1]
    assert users.count_rows(people) == len(every) and users.exists(people) and not users.where("id < -1").exists(people)
    # by a column that the selection makes and one that it drops
    got = users.select(F.lit(1).alias("one"), "name").order_by("one").order_by("id", "DESC").frame(people)
    assert got.columns == ["one", "name"]
    with pytest.raises(ValueError):
        users.fetch_link("name").frame(people)
    with pytest.raises(ValueError):
        users.out("follows", 0)


def test_durations(spark):
    df = spark.range(1).select(F.lit("2024-01-10 00:00:00").cast("timestamp").alias("t"))
    assert df.select((F.col("t") - S.duration("1w1d2h30m15s5ms")).cast("string").alias("t")).first()[0] == "2024-01-01 21:29:44.995"
    with pytest.raises(ValueError):
        S.duration("3 days")
    assert len({r[0] for r in spark.range(5).select(S.rand_uuid()).collect()}) == 5


def test_typed_records_and_wrappers(people):
    @dataclass
    class User:
        id: int
        name: str

    ids = [r["id"] for r in Query().from_table("user").order_by("id").frame(people).collect()]
    assert records.raw_typed(people, User, "SELECT * FROM {user} WHERE id = :n", n=ids[0])[0].id == ids[0]
    assert records.find(people, "user", ids[0], User).unwrap().id == ids[0] and not records.find(people, "user", -5, User).exists
    with pytest.raises(LookupError):
        records.find(people, "user", -5, User).unwrap()
    q = Query().from_table("user").order_by("id")
    some = records.read(people, q, User, len(ids) - 1)
    assert [u.id for u in some] == ids[:-1] and some.has_more and some.first.id == ids[0]
    rest = records.read(people, q, User, len(ids), 1)
    assert len(rest) == len(ids) - 1 and not rest.has_more and rest.last.id == rest[-1].id == ids[-1]


def test_deferred_updates_and_permissions(people):
    df = people.frame("user")
    u = mutate.Update().set(name="X").where(P.gt("id", 1)).where("id < 3")
    assert [r["id"] for r in u.apply(df, "id").result.collect()] == [2]
    assert {c["path"] for r in u.returning("diff").apply(df, "id").result.collect() for c in r["changes"]} == {"/name"}
    with pytest.raises(ValueError):
        mutate.Update().apply(df, "id")
    schema = sc.TableSchema("user").with_permissions(update="id <> 2", delete="age > 1000")
    assert mutate.update(df, {"name": "Y"}, "id", "id <= 2", permitted=schema.permitted("update")).result.select("id").collect() == [(1,)]
    assert mutate.delete(df, permitted=schema.permitted("delete")).state.count() == df.count()
    with pytest.raises(ValueError):
        schema.with_permissions(read="true")


def test_edge_schemas_and_vector_indexes(spark, people):
    e = sc.typed_edge("follows", "user", "user", sc.Field("since", "int", assertion="since > 0"))
    edges = spark.createDataFrame([(1, 2, 5), (1, 99, 0), (None, 2, 1)], "in long, out long, since long")
    users = (people.frame("user"), "id")
    assert sorted((r["in"] or 0, r["out"], r["end"]) for r in e.broken(edges, {"user": users}).collect()) == [(0, 2, "in"), (1, 99, "out")]
    assert e.violations(edges, "out").collect() == [(99, "since", "assert")]
    assert e.reversed("followed").from_table == "user" and sc.bidirectional_edge("knows", "user").to_table == "user"
    moved = sc.EdgeSchema("follows", from_table="user", to_table="post")
    assert ("modify_edge", False) in {(c.op, c.safe) for c in sc.differences([e], [moved])}
    v = sc.TableSchema("chunk").with_indexes(sc.vector_index("near", "v", 3, distance="COSINE"), sc.search_index("text", "t"))
    assert v.violations(spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "id long, v array<double>"), "id").collect() == [(2, "v", "dimension")]
    new = v.with_permissions(select="id > 0")
    assert [c.op for c in sc.differences([v], [new])] == ["modify_permissions"]
    for bad in (lambda: sc.vector_index("x", "v", 0), lambda: sc.vector_index("x", "v", 3, "mtree", "JACCARD"), lambda: sc.Index("x", ("a",), kind="tree")):
        with pytest.raises(ValueError):
            bad()


def test_reports_history_and_cache_keys(spark, people):
    r = sc.report([("warning", "b", "not declared"), ("error", "a", "missing")])
    assert (r["errors"], r["warnings"], r["failed"]) == (1, 1, True) and r["text"].splitlines()[0] == "error: a: missing"
    history = spark.createDataFrame([("1", "first", None, "aa", 3), ("2", "second", None, "bb", None)], sc.HISTORY)
    assert sc.pending(history, {"1": "aa", "2": "cc", "3": "dd"}) == (["3"], ["2"])
    c = Cache()

    @c.cached("user")
    def older(n):
        return people.frame("user").where(F.col("age") > n)

    assert is_cached(older) and not is_cached(len) and older(20) is older(20) and older(30) is not older(20)
    key = key_of(older.__wrapped__, 20)
    assert c.has(key) and c.stats()["ratio"] == 0.5 and c.invalidate(key=key) == 1 and not c.has(key)
    assert c.invalidate(pattern="*older*") == 1 and c.invalidate() == 0


def test_explained_plans(people):
    assert "Physical Plan" in hints.explained(people.frame("user")) and "Optimized Logical Plan" in hints.explained(people.frame("user"), full=True)


def test_cached_functions_tell_frames_apart(spark):
    c = Cache()

    @c.cached()
    def doubled(df, n):
        return df.withColumn("n", F.col("id") * n)

    assert doubled(spark.range(3), 2).count() == 3 and doubled(spark.range(100), 2).count() == 100
    assert doubled(spark.range(3), 2) is doubled(spark.range(3), 2) and doubled(spark.range(3), 3) is not doubled(spark.range(3), 2)
    with pytest.raises(TypeError):
        doubled(spark.range(3), object())


def test_bound_values():
    assert S.bound("a = :x and b = ':x' and `:x`::int = :xx -- :x", {"x": "it's"}) == "a = 'it\\'s' and b = ':x' and `:x`::int = :xx -- :x"
    assert [S.literal(v) for v in (None, True, 3, 1 << 40, [1, "a"], b"\x01")] == ["NULL", "TRUE", "(3)", f"{1 << 40}L", "array((1), 'a')", "X'01'"]
    with pytest.raises(TypeError):
        S.literal(object())


def test_repeated_edges_and_loops_both_ways(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (2, 2), (3, 3)], "`in` long, out long")
    c = Catalog(spark).add("n", nodes).add("two", nodes.where("id < 3")).add("three", nodes.where("id = 3")).add_edge("e", edges, "n", "n")
    assert Query().from_table("two").traverse("<->e").frame(c).count() == 4
    assert Query().from_table("three").traverse("<->e").frame(c).count() == 1


def test_typed_writes(spark):
    @dataclass
    class User:
        id: int
        name: str
        age: int | None = None

    rows = spark.createDataFrame([(1, "Ann", 30), (2, "Bo", None)], "id long, name string, age int")
    m, made = records.create(rows, [User(3, "Cy"), User(4, "Di", 5)], "id")
    assert sorted(made, key=lambda u: u.id) == [User(3, "Cy"), User(4, "Di", 5)] and m.state.count() == 4
    m, put = records.put(rows, [User(1, "Anne"), User(9, "New", 1)], "id")
    assert sorted(u.name for u in put) == ["Anne", "New"] and {(r["id"], r["age"]) for r in m.state.collect()} == {(1, None), (2, None), (9, 1)}
    m, changed = records.change(rows, "id", 2, User, age=7)
    assert changed == User(2, "Bo", 7) and records.change(rows, "id", 99, User, age=7)[1] is None and records.create(rows, [], "id")[1] == []
    assert records.untyped({"a": 1}) == {"a": 1}


def test_levels_of_searches_broadcast_nothing(spark, monkeypatch):
    """Neither edges nor what is met pass through the driver, however small they look."""
    from recordspark.operators import versions
    from recordspark.sources.storage import cut

    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    for module in (graph, versions):
        monkeypatch.setattr(module, "cut", seen)
    rows = [(i, i + 1) for i in range(6)] + [(0, 3)]
    c = Catalog(spark).add("t", spark.range(7), "id").add_edge("next", spark.createDataFrame(rows, "`in` long, out long"), "t", "t")
    assert [tuple(r) for r in graph.shortest_path(c, 0, 5, "next").orderBy("step").collect()] == [(0, 0), (1, 3), (2, 4), (3, 5)]
    assert graph.neighbours(c, 0, "next", 2, "out").count() == 4
    g = versions.graph(spark.createDataFrame(rows, "parent long, version long"))
    assert {tuple(r) for r in g.descendants(2).collect()} == {(3, 1), (4, 2), (5, 3), (6, 4)} and g.ancestors(3).count() == 3
    assert len(plans) > 15 and not [p for p in plans if "Broadcast" in p]
