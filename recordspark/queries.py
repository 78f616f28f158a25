"""All queries over the folder of tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from datetime import date
from types import SimpleNamespace

from pyspark.sql import functions as F

from recordspark.functions import predicates as P
from recordspark.functions import scalar as S
from recordspark.functions import vectors
from recordspark.operators import graph, mutate, records
from recordspark.operators.aggregate import aggregate_records
from recordspark.plans.query import Query, vector_query
from recordspark.registry import ORACLE_SQL, QUERIES, over, query
from recordspark.sources.catalog import Catalog
from recordspark.sources.ids import id_part, record_id
from recordspark.sources.schema import Field, Index, TableSchema, computed_field, record_field, typed_edge
from recordspark.streaming import feeds

# flagship
@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total, round(avg(l_discount), 6) AS mean_discount
FROM lineitem WHERE l_quantity > 10 GROUP BY ALL""")
def flagship(c):
    return aggregate_records(c, "lineitem", {"n": S.count(), "total": F.round(S.math_sum("l_extendedprice"), 2), "mean_discount": F.round(S.math_mean("l_discount"), 6)}, ["l_returnflag", "l_linestatus"], where=P.gt("l_quantity", 10))


# scans and projections
@query("SELECT c_custkey, c_name AS name, c_acctbal * 2 AS twice, 'x' AS tag FROM customer")
def scan_project(c):
    return over("customer").select("c_custkey", S.field("c_name").alias("name"), (F.col("c_acctbal") * 2).alias("twice"), S.value("x").alias("tag")).frame(c)


@query("SELECT * FROM customer WHERE c_custkey = 7")
def point_lookup(c):
    return over("customer:7").frame(c)


@query("SELECT c_nationkey AS value FROM customer WHERE c_acctbal > 5000")
def select_value(c):
    return over("customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("value")).frame(c)


# predicates
@query("""SELECT o_orderkey FROM orders WHERE o_totalprice >= 1000 AND o_totalprice < 200000 AND o_orderstatus <> 'F' AND o_orderdate <= DATE '2000-01-01' AND o_orderdate > DATE '1995-06-30'""")
def filter_cmp(c):
    p = P.gte("o_totalprice", 1000) & P.lt("o_totalprice", 200000) & P.ne("o_orderstatus", "F") & P.lte("o_orderdate", date(2000, 1, 1)) & P.gt("o_orderdate", date(1995, 6, 30))
    return over("orders").where(p).select("o_orderkey").frame(c)


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_returnflag = 'R' OR l_quantity > 30) AND l_tax = 0.02""")
def filter_logic(c):
    return over("lineitem").where(~(P.eq("l_returnflag", "R") | P.gt("l_quantity", 30))).where(P.eq("l_tax", 0.02)).select("l_orderkey", "l_linenumber").frame(c)


@query("SELECT event_id FROM events WHERE event_type IN ('signup', 'error') AND user_id NOT IN (1, 2, 3)")
def filter_inside(c):
    return over("events").where(P.inside("event_type", ["signup", "error"])).where(P.not_inside("user_id", [1, 2, 3])).select("event_id").frame(c)


@query("SELECT event_id, value IS NULL AS missing FROM events WHERE value IS NULL OR (value IS NOT NULL AND value > 50)")
def filter_null(c):
    return over("events").where(P.is_null("value") | (P.is_not_null("value") & P.gt("value", 50))).select("event_id", F.col("value").isNull().alias("missing")).frame(c)


@query("SELECT p_partkey FROM part WHERE contains(p_name, 'a') AND NOT contains(p_name, 'green')")
def filter_contains_str(c):
    return over("part").where(P.contains("p_name", "a")).where(P.contains_not("p_name", "green")).select("p_partkey").frame(c)


def _words(c: Catalog) -> Catalog:
    df = c.frame("part").withColumn("words", F.split("p_name", " "))
    return c.add("part_words", df, "p_partkey")


_WORDS = "(SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)"


@query(f"SELECT p_partkey FROM {_WORDS} WHERE list_contains(words, (SELECT min(string_split(p_name, ' ')[1]) FROM part))")
def filter_contains_array(c):
    first = c.frame("part").agg(F.min(F.split("p_name", " ")[0])).first()[0]
    return over("part_words").where(P.contains("words", first)).select("p_partkey").frame(_words(c))


@query(f"SELECT p_partkey, list_has_all(words, ['blue']) AS a, list_has_any(words, ['blue', 'red']) AS o FROM {_WORDS}")
def filter_contains_all_any(c):
    df = _words(c).frame("part_words")
    return df.select("p_partkey", P.contains_all("words", ["blue"]).on(df).alias("a"), P.contains_any("words", ["blue", "red"]).on(df).alias("o"))


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_name, '(?i)B.*E')")
def regex_match(c):
    return over("part").where(P.matches("p_name", "(?i)B.*E")).select("p_partkey").frame(c)


@query("SELECT c_custkey FROM customer WHERE c_name LIKE 'Customer%1'")
def like_match(c):
    return over("customer").where(P.like("c_name", "Customer%1")).select("c_custkey").frame(c)


_NOT_WORD = r"[^\p{L}\p{M}\p{Nd}_]+"


@query(f"SELECT doc_id FROM documents WHERE list_has_all(regexp_split_to_array(lower(text), '{_NOT_WORD}'), ['the', 'and'])")
def fulltext_match(c):
    return over("documents").where(P.full_text("text", "the AND")).select("doc_id").frame(c)


@query(f"SELECT doc_id FROM documents WHERE list_has_all(regexp_split_to_array(lower(text), '{_NOT_WORD}'), ['für'])")
def fulltext_unicode(c):
    return over("documents").where(P.full_text("text", "FÜR!")).select("doc_id").frame(c)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def scalar_subquery(c):
    mean = over("orders").select(S.math_mean("o_totalprice").alias("mean")).group_all()
    return over("orders").where(P.gt("o_totalprice", mean.scalar(c))).select("o_orderkey").frame(c)


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def in_subquery(c):
    rich = over("customer").where("c_acctbal > 9000").select("c_custkey")
    return over("orders").where(rich.inside(c, "o_custkey")).select("o_orderkey").frame(c)


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def path_predicate(c):
    return over("customer").where_path("->placed->orders", "o_totalprice > 100000").select("c_custkey").frame(c)


@query("""SELECT s_suppkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_partkey IN
(SELECT l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_totalprice > 400000))""")
def path_predicate_back(c):
    return over("supplier").where_path("<-supplied<-part<-contains<-orders", "o_totalprice > 400000").select("s_suppkey").frame(c)


@query("SELECT c_custkey FROM customer WHERE c_acctbal >= 0")
def row_permission(c):
    c.add("own", c.frame("customer"), "c_custkey", rule=lambda df: df["c_acctbal"] >= 0)
    return over("own").select("c_custkey").frame(c)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, CAST(l_quantity AS BIGINT) % 7 AS rest FROM lineitem WHERE l_quantity >= 30")
def bind_parameters(c):
    q = over("lineitem").where("l_quantity >= :least").bind(m=7, least=30)
    return q.select("l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) AS net", "CAST(l_quantity AS BIGINT) % :m AS rest").frame(c)


@query("SELECT n_name, count(*) AS n, 3 AS least FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 1000 GROUP BY n_name HAVING count(*) >= 3")
def raw_statement(c):
    return records.raw(c, "SELECT n_name, count(*) AS n, :least AS least FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_acctbal > :low GROUP BY n_name HAVING count(*) >= :least", low=1000, least=3)


@query("SELECT o_orderkey, year(o_orderdate) AS year, upper(o_orderstatus) || '!' AS status FROM orders WHERE o_totalprice BETWEEN 1000 AND 90000")
def select_text(c):
    return over("orders").where("o_totalprice between 1000 and 90000").select("o_orderkey", "year(o_orderdate) as year", "upper(o_orderstatus) || '!' as status").frame(c)


# joins and links
@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def fetch_link(c):
    return over("orders").fetch_link("o_custkey", "o_custkey.c_nationkey").select("o_orderkey", F.col("o_custkey.c_name"), F.col("o_custkey.c_nationkey.n_name")).frame(c)


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0")
def raw_join(c):
    return over("supplier").join("nation", "s_nationkey = n_nationkey").where("s_acctbal > 0").select("s_suppkey", "n_name").frame(c)


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_join(c):
    return over("customer").join("orders", "o_custkey = c_custkey", "left_semi").select("c_custkey").frame(c)


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def anti_join(c):
    return over("customer").join("orders", "o_custkey = c_custkey and o_totalprice > 200000", "left_anti").select("c_custkey").frame(c)


# aggregation
@query("SELECT event_type, count(*) AS n, count(value) AS n_value, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM events GROUP BY event_type")
def group_by_agg(c):
    v = {"n": S.count(), "n_value": S.count("value"), "total": F.round(S.math_sum("value"), 4), "mean": F.round(S.math_mean("value"), 6), "low": S.math_min("value"), "high": S.math_max("value")}
    return aggregate_records(c, "events", v, ["event_type"])


@query("SELECT count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem")
def group_all_agg(c):
    return aggregate_records(c, "lineitem", {"n": S.count(), "total": F.round(S.math_sum("l_quantity"), 2)}, group_all=True)


@query("SELECT user_id, count_if(value > 50)::BIGINT AS big, count(*) AS n FROM events GROUP BY user_id")
def count_if(c):
    return aggregate_records(c, "events", {"big": S.count_if(F.col("value") > 50), "n": S.count_if()}, ["user_id"])


@query("SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_returnflag")
def sum_expr(c):
    return aggregate_records(c, "lineitem", {"revenue": F.round(S.math_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)}, ["l_returnflag"])


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def having(c):
    return over("orders").select(S.count().alias("n")).group_by("o_custkey").having("n > 12").frame(c)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def order_by_aggregate(c):
    return over("orders").select(S.count().alias("n")).group_by("o_custkey").order_by("n", "DESC").order_by("o_custkey").limit(10).frame(c)


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n FROM events GROUP BY 1")
def time_bucket(c):
    df = c.frame("events").withColumn("day", S.time_floor("ts", "day").cast("timestamp_ntz"))
    return aggregate_records(c.add("bucketed", df), "bucketed", {"n": S.count()}, ["day"])


@query("SELECT count(*) AS n FROM customer WHERE c_acctbal < 0")
def count_records(c):
    return over("customer").where("c_acctbal < 0").select(S.count().alias("n")).group_all().frame(c)


# order and pages
@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5")
def order_limit_offset(c):
    return over("orders").select("o_orderkey", "o_totalprice").order_by("o_totalprice", "DESC").order_by("o_orderkey").offset(5).limit(20).frame(c)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 1000 ORDER BY o_orderkey LIMIT 1")
def first_record(c):
    return records.first(c, "orders", ("o_orderkey", "ASC"), "o_totalprice > 1000").select("o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 1")
def last_record(c):
    return records.last(c, "orders", ("o_orderkey", "ASC")).select("o_orderkey")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 50")
def page(c):
    p = records.page(c, over("customer").select("c_custkey", "c_name").order_by("c_custkey"), 3, 25)
    return c.spark.createDataFrame(p.items)


# functions
@query("SELECT c_custkey, upper(c_name) AS u, lower(c_name) AS l, length(c_name) AS n, c_name || '-' || c_mktsegment AS j, substring(c_name, 3, 4) AS s, regexp_matches(c_name, '@') AS e FROM customer")
def fn_string(c):
    return over("customer").select("c_custkey", S.string_upper("c_name").alias("u"), S.string_lower("c_name").alias("l"), S.string_len("c_name").cast("long").alias("n"), S.string_concat("c_name", F.lit("-"), "c_mktsegment").alias("j"), S.string_slice("c_name", 2, 4).alias("s"), S.is_email("c_name").alias("e")).frame(c)


@query("SELECT c_custkey, abs(c_acctbal) AS a, ceil(c_acctbal) AS c, floor(c_acctbal) AS f, round(c_acctbal, 1) AS r FROM customer")
def fn_math(c):
    return over("customer").select("c_custkey", S.math_abs("c_acctbal").alias("a"), S.math_ceil("c_acctbal").alias("c"), S.math_floor("c_acctbal").alias("f"), S.math_round("c_acctbal", 1).alias("r")).frame(c)


@query(f"SELECT p_partkey, len(words)::BIGINT AS n, list_contains(words, 'blue') AS b FROM {_WORDS}")
def fn_array(c):
    return over("part_words").select("p_partkey", S.array_length("words").cast("long").alias("n"), S.array_contains("words", "blue").alias("b")).frame(_words(c))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS t FROM events")
def fn_time(c):
    return over("events").select("event_id", S.time_format("ts", "%Y-%m-%d %H:%M").alias("t")).frame(c)


@query("SELECT event_id, strftime(ts, '%d.%m.%Y at %H o''clock, 100%% day''s %j') AS t FROM events")
def fn_time_letters(c):
    return over("events").select("event_id", S.time_format("ts", "%d.%m.%Y at %H o'clock, 100%% day's %j").alias("t")).frame(c)


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 26 HOUR")
def fn_duration(c):
    newest = over("events").select(S.math_max("ts").alias("ts")).group_all().scalar(c)
    return over("events").where(P.gt("ts", newest - S.duration("1d2h"))).select("event_id").frame(c)


@query("SELECT c_custkey, upper(c_name) AS u, greatest(c_acctbal, 100) AS g FROM customer")
def fn_call(c):
    return over("customer").select("c_custkey", S.call("upper", "c_name").alias("u"), S.call("greatest", "c_acctbal", 100.0).alias("g")).frame(c)


@query("SELECT ts::TIMESTAMP AS ts, event_id FROM events")
def fn_datetime(c):
    df = c.frame("events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("text"))
    return df.select("event_id", S.to_datetime("text").cast("timestamp_ntz").alias("ts"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS s, CAST(p_retailprice AS BIGINT) AS i, try_cast(p_name AS DOUBLE) AS d, true AS is_text FROM part WHERE p_retailprice = floor(p_retailprice) OR p_retailprice % 1 < 0.5")
def fn_cast(c):
    return over("part").where("p_retailprice = floor(p_retailprice) or p_retailprice % 1 < 0.5").select("p_partkey", S.cast("p_size", "string").alias("s"), S.cast("p_retailprice", "int").alias("i"), S.cast("p_name", "float").alias("d"), S.type_is("p_name", "string").alias("is_text")).frame(c)


@query("SELECT 'customer:' || c_custkey AS id, CAST(c_custkey AS VARCHAR) AS part FROM customer")
def fn_record_id(c):
    df = over("customer").select(record_id("customer", "c_custkey").alias("id")).frame(c)
    return df.select("id", id_part("id").alias("part"))


@query("SELECT CASE WHEN regexp_full_match(p_name, '[A-Za-z0-9_]+') THEN 'part:' || p_name ELSE 'part:<' || p_name || '>' END AS id, p_name AS part FROM part UNION ALL SELECT 't:<a:b c>', 'a:b c'")
def record_id_text(c):
    df = c.frame("part").select(record_id("part", "p_name").alias("id"))
    return df.union(c.spark.range(1).select(record_id("t", F.lit("a:b c")))).select("id", id_part("id").alias("part"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(c):
    return over("events").select("event_id", S.json_field("props", "k").alias("k")).frame(c)


# graph
_KNOWS = """knows AS (SELECT c_custkey AS a, (c_custkey + 1) % n AS b FROM customer, size UNION ALL SELECT c_custkey, (7 * c_custkey + 3) % n FROM customer, size
UNION ALL SELECT c_custkey, (c_custkey - 1 + n) % n FROM customer, size WHERE c_custkey % 3 = 0)"""
_WITH = f"WITH RECURSIVE size AS (SELECT count(*) AS n FROM customer), {_KNOWS}"


@query("SELECT o_custkey AS \"in\", o_orderkey AS \"out\" FROM orders WHERE o_custkey = 7")
def out_edges(c):
    return graph.edges_of(c, 7, "placed")


@query("SELECT c_custkey AS \"in\", CAST(c_nationkey AS BIGINT) AS \"out\" FROM customer WHERE c_nationkey = 3")
def in_edges(c):
    return graph.edges_of(c, 3, "lives_in", "in")


@query("SELECT orders.* FROM orders WHERE o_custkey = 7")
def related_out(c):
    return graph.related(c, 7, "placed", "orders")


@query("SELECT customer.* FROM customer WHERE c_nationkey = 3")
def related_in(c):
    return graph.related(c, 3, "lives_in", "customer", "in")


@query("SELECT p_partkey, p_name FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_custkey = 7")
def two_hop(c):
    return over("customer:7").traverse("->placed->orders->contains->part").select("p_partkey", "p_name").frame(c)


@query(f"{_WITH} SELECT c_custkey FROM (SELECT b AS x FROM knows WHERE a = 6 UNION ALL SELECT a FROM knows WHERE b = 6) JOIN customer ON x = c_custkey")
def both_hop(c):
    return over("customer:6").traverse("<->knows<->customer").select("c_custkey").frame(c)


@query(f"{_WITH} SELECT a AS \"in\", b AS \"out\" FROM knows WHERE a = 6")
def edge_rows(c):
    return over("customer:6").traverse("->knows").frame(c)


@query(f"{_WITH} SELECT c_custkey FROM (SELECT b AS x FROM knows WHERE a = 6 UNION ALL SELECT k.b FROM knows j JOIN knows k ON j.b = k.a WHERE j.a = 6) JOIN customer ON x = c_custkey")
def depth_traverse(c):
    return graph.traverse_with_depth(c, 6, "knows", "customer", 2).select("c_custkey")


@query("SELECT count(*) AS count FROM orders WHERE o_custkey = 7")
def count_related(c):
    return graph.count_related(c, 7, "placed")


@query(f"{_WITH} SELECT x AS id, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree, (sum(i) + sum(o))::BIGINT AS total FROM (SELECT a AS x, 0 AS i, 1 AS o FROM knows UNION ALL SELECT b, 1, 0 FROM knows) GROUP BY x")
def degree_all(c):
    return graph.degrees(c, "knows")


@query(f"{_WITH} SELECT count_if(b = 6)::BIGINT AS in_degree, count_if(a = 6)::BIGINT AS out_degree, (count_if(a = 6) + count_if(b = 6))::BIGINT AS total FROM knows")
def degree_one(c):
    return graph.degree(c, 6, "knows")


@query(f"{_WITH} SELECT DISTINCT b AS id FROM knows WHERE a = 6 AND b IN (SELECT a FROM knows WHERE b = 6)")
def mutual(c):
    return graph.mutual(c, 6, "knows")


@query(f"""{_WITH}, both_ways AS (SELECT a, b FROM knows UNION ALL SELECT b, a FROM knows),
reach(x, d) AS (SELECT 6::BIGINT, 0 UNION SELECT b, d + 1 FROM reach JOIN both_ways ON x = a WHERE d < 2)
SELECT x AS id, min(d) AS depth FROM reach WHERE x <> 6 GROUP BY x""")
def neighbours_2(c):
    return graph.neighbours(c, 6, "knows", 2)


def _path_sql(a: str, b: str, steps: str, max_depth: int = 10) -> str:
    """Shortest path by levels; a record is met from the smallest one of the level before."""
    return f"""{_WITH}, steps AS ({steps}), reach(x, d) AS (SELECT {a}, 0 UNION SELECT b, d + 1 FROM reach JOIN steps ON x = a WHERE d < {max_depth}),
dist AS (SELECT x, min(d) AS d FROM reach GROUP BY x),
parent AS (SELECT b AS x, min(a) AS p FROM steps JOIN dist u ON u.x = a JOIN dist v ON v.x = b AND v.d = u.d + 1 GROUP BY b),
back(x, step) AS (SELECT x, d FROM dist WHERE x = {b} UNION ALL SELECT p, step - 1 FROM back JOIN parent ON parent.x = back.x WHERE step > 0)"""


@query(_path_sql("0::BIGINT", "25", "SELECT a, b FROM knows") + " SELECT step, x AS id FROM back")
def shortest_path(c):
    return graph.shortest_path(c, 0, 25, "knows")


@query(_path_sql("0::BIGINT", "24", "SELECT a, b FROM knows WHERE b <> 3") + " SELECT step, x AS id, c_custkey, c_name FROM back JOIN customer ON c_custkey = x")
def shortest_path_records(c):
    # without the condition, 3 is on the way
    return graph.shortest_path(c, 0, 24, "knows", where="out <> 3", table="customer").select("step", "id", "c_custkey", "c_name")


def _text_keys(c: Catalog) -> Catalog:
    """Customers with text keys, and an edge between them."""
    name = lambda k: F.concat(F.lit("u "), F.col(k).cast("string"))
    c.add("people", c.frame("customer").withColumn("id", name("c_custkey")))
    return c.add_edge("follows", c.frame("knows").select(name("in").alias("in"), name("out").alias("out")), "people", "people")


_TEXT_STEPS = "SELECT 'u ' || a AS a, 'u ' || b AS b FROM knows"


@query(_path_sql("'u 0'", "'u 25'", _TEXT_STEPS) + " SELECT step, x AS id FROM back")
def shortest_path_text(c):
    return graph.shortest_path(_text_keys(c), "u 0", "u 25", "follows")


@query(f"""{_WITH}, s AS ({_TEXT_STEPS}), both_ways AS (SELECT a, b FROM s UNION ALL SELECT b, a FROM s),
reach(x, d) AS (SELECT 'u 6', 0 UNION SELECT b, d + 1 FROM reach JOIN both_ways ON x = a WHERE d < 2)
SELECT x AS id, min(d) AS depth FROM reach WHERE x <> 'u 6' GROUP BY x""")
def neighbours_text(c):
    return graph.neighbours(_text_keys(c), "u 6", "follows", 2)


@query(f"{_WITH}, s AS ({_TEXT_STEPS}) SELECT a AS \"in\", b AS \"out\" FROM s WHERE NOT (a = 'u 0' AND b = 'u 1') UNION ALL SELECT 'u 1', 'new one'")
def relate_text(c):
    return graph.relate(graph.unrelate(_text_keys(c).frame("follows"), "u 0", "u 1"), "u 1", "new one")


@query(f"{_WITH} SELECT DISTINCT c_custkey FROM knows j JOIN knows k ON j.b = k.a JOIN customer ON k.b = c_custkey WHERE j.a = 6 AND k.b <> 6 AND k.b NOT IN (SELECT b FROM knows WHERE a = 6)")
def friends_of_friends(c):
    friends = over("customer:6").out("knows").select("c_custkey")
    return over("customer:6").out("knows", 2).where("c_custkey <> 6").where(~friends.inside(c, "c_custkey")).select("c_custkey").frame(c).distinct()


@query(f"{_WITH} SELECT c_name FROM knows j JOIN knows k ON j.b = k.a JOIN customer ON k.b = c_custkey WHERE j.a = 6")
def hop_depth(c):
    return over("people:<u 6>").out("follows", 2).select("c_name").frame(_text_keys(c))


@query(f"""{_WITH}, s AS (SELECT a, b FROM knows WHERE a % 5 = 0 AND b % 3 = 0)
SELECT c_custkey AS id, (SELECT count(*) FROM s WHERE b = c_custkey) AS in_degree, (SELECT count(*) FROM s WHERE a = c_custkey) AS out_degree, (SELECT count(*) FROM s WHERE b = c_custkey) + (SELECT count(*) FROM s WHERE a = c_custkey) AS total FROM customer""")
def degree_zero(c):
    c.add_edge("some", c.frame("knows").where("`in` % 5 = 0 and out % 3 = 0"), "customer", "customer")
    return graph.degrees(c, "some", "customer")


@query("SELECT c_custkey, coalesce(string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey), 'none') AS found FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 200000 GROUP BY c_custkey")
def collected_related(c):
    c.add("large_orders", c.frame("orders").where("o_totalprice > 200000"), "o_orderkey")
    df = graph.collected(c, "customer", "placed", "large_orders", ["o_orderkey", "o_orderstatus"], "orders")
    each = F.transform("orders", lambda x: F.concat_ws(":", x["o_orderkey"].cast("string"), x["o_orderstatus"]))
    return df.select("c_custkey", F.coalesce(F.array_join(each, ","), F.lit("none")).alias("found"))


@query(f"{_WITH} SELECT count(*) AS n FROM (SELECT * FROM knows WHERE NOT (a = 0 AND b = 1) UNION ALL SELECT 1, 2)")
def relate_unrelate(c):
    return graph.relate(graph.unrelate(c.frame("knows"), 0, 1), 1, 2).agg(F.count("*").alias("n"))


# vectors
def sample_vector(c: Catalog) -> list[float]:
    return [float(x) for x in c.frame("embeddings").where("vec_id = 0").first()["embedding"]]


_A, _Q = "embedding::DOUBLE[]", "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
_Z = f"list_zip({_A}, {_Q})"
_METRIC_SQL = {
    "COSINE": f"list_cosine_similarity({_A}, {_Q})",
    "EUCLIDEAN": f"list_distance({_A}, {_Q})",
    "MANHATTAN": f"list_sum(list_transform({_Z}, lambda p: abs(p[1] - p[2])))",
    "CHEBYSHEV": f"list_max(list_transform({_Z}, lambda p: abs(p[1] - p[2])))",
    "MINKOWSKI": f"pow(list_sum(list_transform({_Z}, lambda p: pow(abs(p[1] - p[2]), 3))), 1.0 / 3)",
    "HAMMING": f"list_sum(list_transform({_Z}, lambda p: CASE WHEN p[1] <> p[2] THEN 1.0 ELSE 0.0 END))",
    "JACCARD": f"len(list_intersect({_A}, {_Q}))::DOUBLE / len(list_distinct(list_concat({_A}, {_Q})))",
    "PEARSON": f"list_cosine_similarity(list_transform({_A}, lambda x: x - list_avg({_A})), list_transform({_Q}, lambda x: x - list_avg({_Q})))",
}


def knn_sql(metric: str) -> str:
    """The ten nearest of vector 0."""
    direction = "DESC" if vectors.is_similarity(metric) else "ASC"
    sql = f"WITH s AS (SELECT vec_id, {_METRIC_SQL[metric]} AS score FROM embeddings) SELECT vec_id, round(score, 6) AS score FROM s ORDER BY s.score {direction}, vec_id LIMIT 10"
    if metric in ("PEARSON", "MANHATTAN", "CHEBYSHEV", "MINKOWSKI", "HAMMING", "JACCARD"):  # lambdas take no subqueries
        sql = f"WITH q AS MATERIALIZED (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, {_METRIC_SQL[metric].replace(_Q, 'q')} AS score FROM embeddings, q) SELECT vec_id, round(score, 6) AS score FROM s ORDER BY s.score {direction}, vec_id LIMIT 10"
    return sql


def _knn(metric: str) -> None:
    def run(c: Catalog) -> DataFrame:
        v = sample_vector(c)
        return vector_query("embeddings", "embedding", v, 10, metric).select("vec_id", F.round(vectors.score("embedding", v, metric), 6).alias("score")).frame(c)

    run.__name__ = f"knn_{metric.lower()}"
    query(knn_sql(metric))(run)


for _m in _METRIC_SQL:
    _knn(_m)


@query(f"SELECT vec_id FROM embeddings WHERE {_METRIC_SQL['COSINE']} >= 0.5 ORDER BY {_METRIC_SQL['COSINE']} DESC, vec_id LIMIT 50")
def knn_threshold(c):
    return vector_query("embeddings", "embedding", sample_vector(c), 50, "COSINE", 0.5).select("vec_id").frame(c)


@query(f"SELECT vec_id FROM embeddings WHERE label = 3 ORDER BY {_METRIC_SQL['EUCLIDEAN']}, vec_id LIMIT 5")
def knn_filtered(c):
    return vector_query("embeddings", "embedding", sample_vector(c), 5, "EUCLIDEAN").where("label = 3").select("vec_id").frame(c)


@query(f"SELECT vec_id, round({_METRIC_SQL['COSINE']}, 6) AS similarity FROM embeddings")
def similarity_score(c):
    return over("embeddings").select("vec_id").similarity_score("embedding", sample_vector(c)).frame(c).withColumn("similarity", F.round("similarity", 6))


@query(f"SELECT vec_id, round({_METRIC_SQL['EUCLIDEAN']}, 6) AS d FROM embeddings")
def mahalanobis_identity(c):
    v = sample_vector(c)
    inverse = [[float(i == j) for j in range(len(v))] for i in range(len(v))]
    return over("embeddings").select("vec_id", F.round(vectors.score("embedding", v, "MAHALANOBIS", inverse=inverse), 6).alias("d")).frame(c)


@query(f"SELECT vec_id, CASE WHEN label = 3 THEN NULL ELSE round({_METRIC_SQL['COSINE']}, 6) END AS similarity FROM embeddings")
def similarity_of_zero(c):
    v = sample_vector(c)
    zeroed = c.frame("embeddings").withColumn("embedding", F.when(F.col("label") == 3, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")))
    return Query().from_table("zeroed").select("vec_id").similarity_score("embedding", v).frame(c.add("zeroed", zeroed, "vec_id")).withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH q AS MATERIALIZED (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0)
SELECT vec_id, CASE WHEN label = 3 THEN NULL ELSE round({_METRIC_SQL['PEARSON'].replace(_Q, 'q')}, 6) END AS similarity FROM embeddings, q""")
def pearson_of_constant(c):
    v = sample_vector(c)
    flat = c.frame("embeddings").withColumn("embedding", F.when(F.col("label") == 3, F.transform("embedding", lambda x: x * 0 + 0.3)).otherwise(F.col("embedding")))
    return flat.select("vec_id", F.round(vectors.score("embedding", v, "PEARSON"), 6).alias("similarity"))


# mutations
_NATION = "n_nationkey, n_name, n_regionkey"


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def update_set(c):
    return mutate.update(c.frame("customer"), {"c_acctbal": 0.0}, "c_custkey", P.lt("c_acctbal", 0)).state.select("c_custkey", "c_acctbal")


@query("SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'X' ELSE n_name END AS n_name, n_regionkey FROM nation")
def merge(c):
    return mutate.merge(c.frame("nation"), "n_nationkey", 3, {"n_name": "X"}).state


@query("SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'X' ELSE n_name END AS n_name, CASE WHEN n_nationkey = 3 THEN NULL ELSE n_regionkey END AS n_regionkey FROM nation")
def replace(c):
    return mutate.replace(c.frame("nation"), "n_nationkey", 3, {"n_name": "X"}).state


@query(f"SELECT {_NATION} FROM nation WHERE n_nationkey <> 3 UNION ALL VALUES (3, 'NEW', 1), (99, 'LAST', 2)")
def upsert(c):
    return mutate.upsert(c.frame("nation"), [{"n_nationkey": 3, "n_name": "NEW", "n_regionkey": 1}, {"n_nationkey": 99, "n_name": "LAST", "n_regionkey": 2}], "n_nationkey").state


@query(f"SELECT {_NATION} FROM nation WHERE n_nationkey <> 3 UNION ALL VALUES (3, 'LAST', 2), (99, 'B', 1)")
def upsert_repeated(c):
    rows = [(3, "NEW", 1), (99, "A", 1), (3, "LAST", 2), (99, "B", 1)]
    return mutate.upsert(c.frame("nation"), [dict(zip(("n_nationkey", "n_name", "n_regionkey"), r, strict=True)) for r in rows], "n_nationkey").state


@query(f"SELECT * FROM (SELECT {_NATION} FROM nation UNION ALL VALUES (60, NULL, 1)) WHERE n_name IS NOT NULL AND n_name <> 'CHINA' UNION ALL VALUES (70, NULL, 4), (71, 'CHINA', 0)")
def upsert_conflict(c):
    df = c.frame("nation").where("n_name <> 'CHINA'").union(c.spark.range(1).selectExpr("60", "cast(null as string)", "1"))
    rows = c.spark.createDataFrame([(70, None, 4), (71, "CHINA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    return mutate.upsert(df, rows, "n_nationkey", on=["n_name"]).state


@query(f"SELECT {_NATION} FROM nation UNION ALL VALUES (98, 'A', 1), (99, 'B', NULL)")
def insert_many(c):
    return mutate.insert(c.frame("nation"), [{"n_nationkey": 98, "n_name": "A", "n_regionkey": 1}, {"n_nationkey": 99, "n_name": "B", "n_regionkey": None}], "n_nationkey").state


@query("SELECT * FROM orders WHERE NOT coalesce(o_totalprice > 100000, false)")
def delete_where(c):
    return mutate.delete(c.frame("orders"), "o_totalprice > 100000").state


@query("SELECT * FROM nation WHERE n_nationkey IN (1, 2)")
def delete_many(c):
    return mutate.delete_many(c.frame("nation"), [1, 2, 1000], "n_nationkey").result


@query("SELECT * FROM nation WHERE n_regionkey = 1")
def return_before(c):
    return mutate.update(c.frame("nation"), {"n_name": "Y"}, "n_nationkey", "n_regionkey = 1", "before").result


@query("SELECT n_nationkey, 'replace' AS op, '/n_name' AS path, 'Y' AS value FROM nation WHERE n_regionkey = 1 AND n_name <> 'Y'")
def return_diff(c):
    d = mutate.update(c.frame("nation"), {"n_name": "Y"}, "n_nationkey", "n_regionkey = 1", "diff").result
    return d.select("n_nationkey", F.explode("changes").alias("x")).select("n_nationkey", "x.*")


@query("SELECT n_nationkey, 'remove' AS op, '/n_name' AS path, NULL::VARCHAR AS value FROM nation WHERE n_nationkey < 5 UNION ALL SELECT n_nationkey, 'add', '/size', '1' FROM nation WHERE n_nationkey < 5")
def diff_of_fields(c):
    old = c.frame("nation")
    d = mutate.diff(old, old.where("n_nationkey < 5").drop("n_name").withColumn("size", F.lit(1)), "n_nationkey")
    return d.select("n_nationkey", F.explode("changes").alias("x")).select("n_nationkey", "x.*")


@query("SELECT c_custkey, c_name, 'new' AS status FROM customer")
def backfill_default(c):
    return mutate.backfill(c.frame("customer"), "status", "new").select("c_custkey", "c_name", "status")


@query("SELECT count(*) AS n, max(n_nationkey) AS top FROM (SELECT n_nationkey FROM nation WHERE n_nationkey <> 1 UNION ALL SELECT 50)")
def transaction(c):
    t = mutate.Transaction({"nation": c.frame("nation")})
    t.execute("nation", mutate.insert, [{"n_nationkey": 50, "n_name": "T", "n_regionkey": 0}], "n_nationkey")
    t.execute("nation", mutate.delete, "n_nationkey = 1")
    return t.commit()["nation"].agg(F.count("*").alias("n"), F.max("n_nationkey").alias("top"))


# schemas
_SCHEMA = TableSchema("customer", (Field("c_acctbal", "float", assertion="c_acctbal >= 0"), Field("c_name", "string", nullable=False), record_field("c_nationkey", "nation")), (Index("by_name", ("c_mktsegment",), unique=True),))


@query("SELECT c_custkey, 'c_acctbal' AS field, 'assert' AS kind FROM customer WHERE c_acctbal < 0")
def assert_violations(c):
    return _SCHEMA.violations(c.frame("customer"), "c_custkey")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def unique_violations(c):
    return _SCHEMA.duplicates(c.frame("customer"))["by_name"]


@query("SELECT c_custkey, 'c_nationkey' AS field FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)")
def dangling_links(c):
    return _SCHEMA.dangling(c.frame("customer"), "c_custkey", {"nation": (c.frame("nation").where("n_regionkey <> 1"), "n_nationkey")})


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def computed(c):
    return TableSchema("lineitem", (computed_field("net", "l_extendedprice * (1 - l_discount)", "float"),)).applied(c.frame("lineitem")).select("l_orderkey", "l_linenumber", "net")


# changes and time
@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS action FROM events WHERE event_id % 10 = 0 OR event_id % 7 = 0 UNION ALL SELECT event_id + 100000000, 'CREATE' FROM events WHERE event_id % 50 = 1")
def snapshot_diff(c):
    old = c.frame("events")
    new = old.where("event_id % 10 <> 0").withColumn("user_id", F.when(F.col("event_id") % 7 == 0, F.col("user_id") + 1).otherwise(F.col("user_id")))
    more = old.where("event_id % 50 = 1").withColumn("event_id", F.col("event_id") + 100000000)
    return feeds.snapshot_changes(old, new.union(more), "event_id")


@query("SELECT c_custkey, 'UPDATE' AS action FROM customer WHERE c_acctbal > 0")
def snapshot_added_field(c):
    old = c.frame("customer")
    return feeds.snapshot_changes(old, old.withColumn("rank", F.when(F.col("c_acctbal") > 0, F.lit(1))), "c_custkey")


@query("SELECT time_bucket(INTERVAL '1 hour', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def window_counts(c):
    rows = c.frame("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return feeds.windowed_counts(rows, "ts", "event_type", "1 hour", "1 hour").withColumn("start", F.col("start").cast("timestamp_ntz"))


# values that are null in all given rows, markers in every clause, kinds of values, odd keys
@query("SELECT o_orderkey, o_custkey, o_orderpriority, NULL::VARCHAR AS note FROM orders UNION ALL VALUES (-1, 7, NULL, NULL), (-2, NULL, NULL, NULL)")
def insert_nulls(c):
    rows = c.frame("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return mutate.insert(rows, [{"o_orderkey": -1, "o_custkey": 7, "o_orderpriority": None, "note": None}, {"o_orderkey": -2, "o_custkey": None, "o_orderpriority": None}], "o_orderkey").state


@query("SELECT c_custkey, CASE WHEN c_custkey IN (1, 2) THEN NULL ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey = 1 THEN 'one' WHEN c_custkey = 2 THEN 'two' ELSE c_name END AS c_name FROM customer")
def upsert_nulls(c):
    rows = c.frame("customer").select("c_custkey", "c_acctbal", "c_name")
    return mutate.upsert(rows, [{"c_custkey": 1, "c_name": "one", "c_acctbal": None}, {"c_custkey": 2, "c_name": "two", "c_acctbal": None}], "c_custkey").state


@query("SELECT o_custkey AS a, o_orderkey AS b, NULL::VARCHAR AS note FROM orders UNION ALL VALUES (1, 2, NULL), (3, 4, NULL)")
def relate_nulls(c):
    return mutate.relate_many(c.frame("placed"), [(1, 2, {"note": None}), (3, 4, {"note": None})]).state.select(F.col("in").alias("a"), F.col("out").alias("b"), "note")


@query("""SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice * 1.5), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > 1000
WHERE o_orderstatus <> 'it''s :x' GROUP BY 1 HAVING count(*) > 10""")
def bind_clauses(c):
    q = over("orders").join("customer", "o_custkey = c_custkey and c_acctbal > :least").where("o_orderstatus <> :odd and ':x' <> :odd")
    q = q.group_by("o_orderpriority").select("o_orderpriority", S.count().alias("n"), F.round(S.math_sum(F.expr("o_totalprice * 1.5")), 2).alias("total")).having("n > :few")
    return q.bind(least=1000, odd="it's :x", few=10).frame(c)


@query("SELECT c_custkey, c_name || ' of ' || 7 AS told, upper(c_mktsegment) AS segment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def bind_mixed(c):
    q = over("customer").where_path("->placed->orders", "o_totalprice > :price")
    return q.select("c_custkey", "c_name || :of || :n AS told", F.upper("c_mktsegment").alias("segment")).bind(price=150_000.0, of=" of ", n=7).frame(c)


@query("SELECT event_id, true AS i, true AS f, true AS t, false AS no, true AS a, true AS o FROM events")
def type_is_kinds(c):
    e = c.frame("events").withColumns({"small": F.col("user_id").cast("int"), "list": F.array("user_id"), "both": F.struct("user_id")})
    return e.select("event_id", S.type_is("small", "int").alias("i"), S.type_is("value", "number").alias("f"), S.type_is("ts", "datetime").alias("t"), S.type_is("value", "int").alias("no"), S.type_is("list", "array").alias("a"), S.type_is("both", "object").alias("o"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey = 5")
def lookup_text_key(c):
    c.add("places", c.frame("nation").withColumn("id", F.col("n_nationkey").cast("string")))
    return over("places:5").select("n_nationkey", "n_name").frame(c).unionByName(over("nation:<no number>").select("n_nationkey", "n_name").frame(c))


@query("SELECT c_custkey, 'UPDATE' AS action FROM customer WHERE c_custkey % 5 <> 0 AND c_acctbal > 0")
def snapshot_null_keys(c):
    before = c.frame("customer").select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("c_custkey"), "c_acctbal")
    return feeds.snapshot_changes(before, before.withColumn("c_acctbal", F.when(F.col("c_acctbal") > 0, 0.0).otherwise(F.col("c_acctbal"))), "c_custkey")


@query(f"{_WITH}, twice AS (SELECT * FROM knows UNION ALL SELECT * FROM knows) SELECT a, b FROM twice WHERE a = 6 OR b = 6")
def both_edges_repeated(c):
    knows = c.frame("knows")
    c.add_edge("twice", knows.union(knows), "customer", "customer")
    return over("customer:6").traverse("<->twice").frame(c).select(F.col("in").alias("a"), F.col("out").alias("b"))


# reading, counting and describing
@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7")
def get_by_id(c):
    row = records.get_record(c, "customer", "7")
    return c.spark.createDataFrame([(row["c_custkey"], row["c_name"])], "c_custkey long, c_name string")


@query("SELECT true AS there, false AS absent, (SELECT count(*) FROM knows_of) AS n, (SELECT count(*) FROM knows_of) > 0 AS some, false AS none FROM (SELECT 1) t".replace("knows_of", "(SELECT 1 FROM orders WHERE o_custkey = 7)"))
def existence_and_counts(c):
    hop = over("customer:7").out("placed")
    flags = (records.exists(c, "customer", 7), records.exists(c, "customer", "no key"), hop.count_rows(c), hop.exists(c), hop.where("o_totalprice < 0").exists(c))
    return c.spark.createDataFrame([flags], "there boolean, absent boolean, n long, some boolean, none boolean")


@query("SELECT table_name AS \"table\", column_name AS \"column\" FROM (SELECT * FROM (VALUES ('nation', 'n_nationkey'), ('nation', 'n_name'), ('nation', 'n_regionkey'), ('placed', 'in'), ('placed', 'out')) v(table_name, column_name))")
def describe(c):
    return c.spark.createDataFrame([(t, n) for t, n, _ in c.describe() if t in ("nation", "placed")], "`table` string, `column` string")


@query("SELECT c_custkey, (SELECT count(*) FROM customer WHERE c_acctbal > 0) > 25 AS has_more FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 15 OFFSET 10")
def page_with_more(c):
    q = over("customer").where("c_acctbal > 0").order_by("c_acctbal", "DESC").order_by("c_custkey").select("c_custkey", "c_acctbal")
    got = records.read(c, q, SimpleNamespace, 15, 10)
    return c.spark.createDataFrame([(x.c_custkey, got.has_more) for x in got], "c_custkey long, has_more boolean")


@query(f"{_WITH} SELECT x.a AS c_custkey FROM knows x JOIN knows y ON x.b = y.a WHERE y.b = 6")
def in_hop_depth(c):
    return over("customer:6").in_("knows", 2).select("c_custkey").frame(c)


@query(f"{_WITH}, both_ways AS (SELECT a, b FROM knows UNION ALL SELECT b, a FROM knows) SELECT y.b AS c_custkey FROM both_ways x JOIN both_ways y ON x.b = y.a WHERE x.a = 6")
def both_hop_depth(c):
    return over("customer:6").both("knows", 2).select("c_custkey").frame(c)


@query(f"SELECT vec_id, round({_METRIC_SQL['COSINE']}, 6) AS near FROM embeddings ORDER BY {_METRIC_SQL['COSINE']} DESC, vec_id LIMIT 8")
def similarity_helper(c):
    return vector_query("embeddings", "embedding", sample_vector(c), 8, "COSINE", score="near").frame(c).select("vec_id", F.round("near", 6).alias("near"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'poor' ELSE c_name END AS c_name FROM customer")
def deferred_update(c):
    u = mutate.Update().set(c_acctbal=0.0).where("c_acctbal < 0").set(c_name="poor").where(P.eq("c_mktsegment", "BUILDING")).returning("none")
    return u.apply(c.frame("customer"), "c_custkey").state.select("c_custkey", "c_acctbal", "c_name")


@query("SELECT 'after' AS image, c_custkey, 1.0 AS c_acctbal FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'full', c_custkey, 1.0 FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'before', c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def return_images(c):
    rows = c.frame("customer").select("c_custkey", "c_acctbal")
    shown = [mutate.update(rows, {"c_acctbal": 1.0}, "c_custkey", "c_acctbal < 0", image).result.select(F.lit(image).alias("image"), "c_custkey", "c_acctbal") for image in ("after", "full", "before", "none")]
    return shown[0].union(shown[1]).union(shown[2]).union(shown[3])


@query("SELECT event_id, true AS past, true AS unlike FROM events")
def now_and_uuids(c):
    return c.frame("events").select("event_id", (F.col("ts") < S.time_now()).alias("past"), (F.length(S.rand_uuid()) == 36).alias("unlike"))


@query("SELECT 1 AS a, o_orderkey AS b, 'out' AS \"end\" FROM orders WHERE o_orderkey % 9 = 0 UNION ALL SELECT NULL, o_orderkey, 'in' FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 9 <> 0")
def edge_violations(c):
    e = c.frame("placed").select(F.when(F.col("out") % 9 == 0, F.lit(1)).when(F.col("out") % 10 != 0, F.col("in")).cast("long").alias("in"), F.when(F.col("out") % 9 == 0, -1 - F.col("out")).otherwise(F.col("out")).alias("out"))
    found = typed_edge("placed", "customer", "orders").broken(e, c.keys())
    return found.select(F.col("in").alias("a"), F.greatest("out", -1 - F.col("out")).alias("b"), "end")


from recordspark import queries_stored  # noqa: E402, F401  registers its queries
