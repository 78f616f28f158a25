"""Indexes: what they read, that nothing is lost, and odd rows."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordspark.functions import predicates as P
from recordspark.functions import vectors
from recordspark.plans import hints
from recordspark.plans.hints import explained
from recordspark.plans.query import Query
from recordspark.sources import schema as sc
from recordspark.sources import search_index, vector_index
from recordspark.sources.catalog import Catalog
from recordspark.sources.indexes import build_indexes

SCHEMA = "id long, v array<float>, colour string"


@pytest.fixture(scope="module")
def clustered(spark):
    """3,000 vectors in 40 clusters, 500 equal ones, and odd ones."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 12)) * 3
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 12)) * 0.4
    rows = [(i, [float(np.float32(c)) for c in v], ["red", "blue"][i % 2]) for i, v in enumerate(x)]
    rows += [(5000 + i, rows[0][1], "red") for i in range(500)]
    rows += [(9000, None, "red"), (9001, [1.0], "red"), (9002, [float("nan")] * 12, "blue"), (9003, [None] * 12, None), (9004, [0.0] * 12, "red"), (9005, [2.0] * 12, "blue"), (None, rows[5][1], "red")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def catalog(spark, rows, metric=None, folder=None, **kw):
    c = Catalog(spark).add("t", rows, "id")
    return c if metric is None else c.add_vector_index("t", vector_index.build(rows, "v", metric, f"file://{folder}", **kw))


def found(c, q, k, metric, **kw):
    near = Query().from_table("t").where("colour is not null").vector_search("v", q, k, metric, **kw)
    return [r["s"] for r in near.select(F.round(vectors.score("v", q, metric), 9).alias("s")).frame(c).collect()]


@pytest.mark.parametrize("metric", vector_index.METRICS)
def test_exact_searches_equal_scans(spark, clustered, tmp_path, metric):
    whole = clustered.where("id is not null and id not in (9001, 9002, 9003)")
    c, plain = catalog(spark, whole, metric, tmp_path / "i", cells=12), catalog(spark, whole)
    queries = [r["v"] for r in whole.where("id in (3, 77, 5001)").orderBy("id").collect()]
    for q in queries:
        for k in (1, 25, 600):
            assert found(c, q, k, metric, exact=True) == found(plain, q, k, metric)


def test_searches_read_few_cells_with_recall(spark, clustered, tmp_path):
    c, plain = catalog(spark, clustered, "EUCLIDEAN", tmp_path / "i"), catalog(spark, clustered)
    index = c.vector_indexes["t", "v"]
    again = vector_index.open_index(spark, index.path)
    assert again.probes == index.probes and (again.cells.centres == index.cells.centres).all()
    assert index.rows(spark).count() == clustered.count() and set(index.rows(spark).columns) == set(clustered.columns)
    queries, hits, wanted = [r["v"] for r in clustered.where("id < 3000 and id % 97 = 0").collect()], 0, 0
    assert len(queries) > 25
    for q in queries:
        got, want = found(c, q, 10, "EUCLIDEAN"), found(plain, q, 10, "EUCLIDEAN")
        hits, wanted = hits + sum(g <= want[-1] for g in got), wanted + len(want)
    assert hits >= 0.9 * wanted
    near = index.near(spark, queries[0])
    assert near.count() < 0.5 * clustered.count() and index.probes < 0.5 * len(index.cells.numbers)
    plan = explained(Query().from_table("t").vector_search("v", queries[0], 5, "EUCLIDEAN").frame(c))
    assert "PartitionFilters" in plan and "_cell" in plan.split("PartitionFilters", 1)[1].splitlines()[0]
    # an exact search leaves cells out too
    assert index.exact(spark, queries[0], 5, lambda x: x).count() < clustered.count() / 2


def test_rows_without_a_score_are_found_last(spark, clustered, tmp_path):
    c = catalog(spark, clustered, "COSINE", tmp_path / "i", cells=5)
    q = clustered.where("id = 3").first()["v"]
    rows = Query().from_table("t").vector_search("v", q, 10_000, "COSINE", exact=True).frame(c)
    assert rows.count() == clustered.count()
    assert Query().from_table("t").vector_search("v", q, 5, "EUCLIDEAN").frame(c).count() == 5  # another metric scans the table
    with pytest.raises(ValueError):
        Query().from_table("t").vector_search("v", [0.0] * 12, 5, "COSINE").frame(c)
    with pytest.raises(ValueError):
        Query().from_table("t").vector_search("v", q, 5, "COSINE", probes=0)
    empty = catalog(spark, clustered.limit(0), "EUCLIDEAN", tmp_path / "e")
    assert empty.vector_indexes["t", "v"].rows(spark).count() == 0
    bad = catalog(spark, clustered.where("id in (9000, 9002, 9003)"), "EUCLIDEAN", tmp_path / "b")
    assert bad.vector_indexes["t", "v"].rows(spark).count() == 3


def test_rules_hold_for_indexed_searches(spark, clustered, tmp_path):
    c = Catalog(spark).add("t", clustered, "id", rule=lambda df: df["colour"] == "red")
    c.add_vector_index("t", vector_index.build(clustered, "v", "EUCLIDEAN", f"file://{tmp_path}/i"))
    q = clustered.where("id = 3").first()["v"]
    for exact in (False, True):
        assert {r["colour"] for r in Query().from_table("t").vector_search("v", q, 20, "EUCLIDEAN", exact=exact).frame(c).collect()} == {"red"}


TEXTS = [(1, "The quick brown fox", "a b"), (2, "quick, the BROWN fox!", "b"), (3, None, "c"), (4, "", None), (5, "Straße für Élodie été", "quick"), (6, "the the the", "x"), (7, "fox brown quick the " * 400, "y"), (8, "brown-fox brown_fox", "z")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, body string, title string").repartition(3)


def test_postings_find_what_scans_find(spark, texts, tmp_path):
    plain = Catalog(spark).add("t", texts, "id")
    c = Catalog(spark).add("t", texts, "id").add_search_index("t", search_index.build(texts, "id", ["body", "title"], f"file://{tmp_path}/s"))
    ask = lambda c, p: sorted(r["id"] for r in Query().from_table("t").where(p).select("id").frame(c).collect())
    for terms in ("fox", "QUICK fox", "the the", "absent", "fox absent", "élodie FÜR", "straße", "brown_fox", "", "!!", "quick"):
        for field in ("body", "title"):
            assert ask(c, P.full_text(field, terms)) == ask(plain, P.full_text(field, terms)), (terms, field)
    for terms in ("quick brown", "brown fox", "the the", "the quick the", "fox brown quick the fox", "brown brown_fox", "the"):
        assert ask(c, P.phrase("body", terms)) == ask(plain, P.phrase("body", terms)), terms
    texts.write.parquet(f"file://{tmp_path}/t")
    df = Query().from_table("t").where(P.full_text("body", "quick fox")).select("id").frame(c.add("t", f"file://{tmp_path}/t", "id"))
    plan = explained(df)
    assert "body#" not in plan and "body:string" not in plan and "_folder" in plan.split("PartitionFilters", 1)[1].splitlines()[0]


def test_search_indexes_need_keys_and_keep_their_analyser(spark, texts, tmp_path):
    with pytest.raises(ValueError):
        search_index.build(texts.union(texts), "id", ["body"], f"file://{tmp_path}/a")
    with pytest.raises(ValueError):
        search_index.build(texts.withColumn("id", F.lit(None).cast("long")), "id", ["body"], f"file://{tmp_path}/b")
    index = search_index.build(texts, "id", ["body"], f"file://{tmp_path}/c", search_index.Analyser(plain=True, stop=("the",), least=3))
    again = search_index.open_index(spark, index.path)
    assert again == index and again.terms(spark, "The Élodie ÉTÉ is") == ["elodie", "ete"]
    assert [r["key"] for r in again.matching(spark, "body", "elodie ETE").collect()] == [5] and again.matching(spark, "body", "the is") is None
    with pytest.raises(ValueError):
        again.matching(spark, "title", "x")
    assert search_index.build(texts.limit(0), "id", ["body"], f"file://{tmp_path}/d").matching(spark, "body", "x").count() == 0


def test_declared_indexes_are_built_and_used(spark, texts, tmp_path):
    rows = texts.withColumn("v", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")))
    s = sc.TableSchema("t", indexes=(sc.vector_index("near", "v", 2), sc.search_index("words", "body"), sc.Index("by_title", ("title",))))
    c = build_indexes(Catalog(spark).add("t", rows, "id", rule=lambda df: df["id"] != 3), s, f"file://{tmp_path}", 4)
    assert set(c.vector_indexes) == {("t", "v")} and set(c.search_indexes) == {("t", "body")} and set(c.layouts) == {("t", "by_title")}
    q = Query().from_table("t").where(P.full_text("body", "fox")).where("title <> 'b'").vector_search("v", [2.0, 1.0], 2, "EUCLIDEAN", exact=True).select("id")
    assert [r["id"] for r in q.frame(c).collect()] == [1, 7]
    laid = Query().from_table("t").hint(hints.Index("t", "by_title", True)).frame(c)
    assert laid.count() == 7 and "layout_by_title" in explained(laid)
    with pytest.raises(KeyError):
        build_indexes(Catalog(spark), s)


def test_rows_are_added_to_indexes(spark, clustered, texts, tmp_path):
    whole = clustered.where("id is not null")
    first, more = whole.where("id % 3 > 0"), whole.where("id % 3 = 0").withColumn("v", F.when(F.col("id") == 9, F.array(*[F.lit(50.0 + i).cast("float") for i in range(12)])).otherwise(F.col("v")))
    index = vector_index.add(spark, vector_index.build(first, "v", "EUCLIDEAN", f"file://{tmp_path}/v", cells=9), more)
    every = first.union(more)
    assert index.rows(spark).count() == every.count()
    c, plain = Catalog(spark).add("t", every, "id").add_vector_index("t", index), Catalog(spark).add("t", every, "id")
    for q in ([50.0] * 12, every.where("id = 6").first()["v"]):
        assert found(c, q, 30, "EUCLIDEAN", exact=True) == found(plain, q, 30, "EUCLIDEAN")
    words = search_index.add(search_index.build(texts.where("id < 5"), "id", ["body"], f"file://{tmp_path}/s"), texts.where("id >= 5"))
    assert sorted(r["key"] for r in words.matching(spark, "body", "fox brown").collect()) == [1, 2, 7, 8]
    with pytest.raises(ValueError):
        search_index.add(words, texts.where("id = 1"))


def test_jaccard_distances_are_those_of_sets_and_cost_what_is_shared():
    rng = np.random.default_rng(8)
    for x in (rng.integers(0, 9, (200, 12)).astype(float), rng.normal(size=(100, 7)), np.array([[0.0, -0.0, 1.0], [1.0, 1.0, 1.0]] * 3), np.zeros((3, 2))):
        centres = x[rng.permutation(len(x))[:20]]
        sets, others = [set(v) for v in x.tolist()], [set(v) for v in centres.tolist()]
        assert (vector_index.far(x, centres, "JACCARD") == np.array([[1 - len(a & b) / len(a | b) for b in others] for a in sets])).all()
    assert vector_index.far(np.zeros((0, 3)), np.ones((2, 3)), "JACCARD").shape == (0, 2)
    x, begun = rng.normal(size=(20_000, 64)), time.process_time()
    cell, away = vector_index.nearest(x, x[:200], "JACCARD")
    assert (cell[:200] == np.arange(200)).all() and not away[:200].any() and (away[200:] == 1).all()
    assert time.process_time() - begun < 6  # pairs of sets, one by one, take far longer


def test_postings_are_put_together_before_they_are_shuffled(spark, texts, tmp_path):
    """One block for each term of a field that a task has met, with every record and every place."""
    more = texts.select("id", "body", "title").union(spark.range(100, 160).selectExpr("id", "concat('the fox ', id, ' the')", "'b'"))
    index = search_index.build(more.coalesce(1), "id", ["body", "title"], f"file://{tmp_path}/s")
    blocks = spark.read.parquet(f"file://{tmp_path}/s/postings").groupBy("term", "field").count()
    assert blocks.where("count > 1").count() == 0
    rows, words = more.collect(), search_index.Analyser().words
    for field in ("body", "title"):
        split = {r["id"]: r["w"] or [] for r in more.select("id", words(F.col(field)).alias("w")).collect()}
        for term in ("the", "fox", "b", "quick", "absent", "straße"):
            want = {i: [p for p, x in enumerate(w) if x == term] for i, w in split.items() if term in w}
            got = index.postings(spark, field, [term]).collect()
            assert len(got) == len(want) and {r["key"]: list(r["positions"]) for r in got} == want
    assert len(rows) == 68
    odd = more.select(F.concat(F.lit("k"), "id").alias("id"), "body")
    named = search_index.build(odd, "id", ["body"], f"file://{tmp_path}/n")
    assert named.matching(spark, "body", "fox the").count() == 60 + 3 and named.matching(spark, "body", "the fox", phrase=True).count() == 60 + 1
