"""The engine's registered queries, each with the same question as SQL."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import aggregate, as_of_join, compact, facet, interval_join, read_index, statistics, update_by_key, write_index
from .functions.vocabulary import call
from .operators.predicates import Path, all_of, any_of, where
from .operators.windows import sessions, top_rows
from .operators.joins import small_join
from .plans.session import footer_read
from .sources import datasource, storage
from .sources.formats import read_as, write_as
from .sources.storage import Options, create_table
from .streaming.windows import facet_stream, read_stream, session_windows, windowed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their words as an array."""
    return read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.split(F.lower("text"), " ").alias("tokens"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with their properties as a map."""
    return read(spark, sf_dir, "events").withColumn("props", F.from_json("props", "map<string,string>"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their labels, null where there are none."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(read(spark, sf_dir, "labels"), "doc_id", "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with nested structs."""
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation"), F.struct(F.col("c_acctbal").alias("balance")).alias("account")).alias("place")).alias("who")
    )


# --- filters -------------------------------------------------------------------------------


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#12'")
def f_eq(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_brand") == "Brand#12").select("p_partkey", "p_brand")


@query("SELECT p_partkey, p_type FROM part WHERE p_type <> 'ECONOMY'")
def f_neq(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_type") != "ECONOMY").select("p_partkey", "p_type")


@query("SELECT d.doc_id, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS NOT DISTINCT FROM NULL OR toxic IS NOT DISTINCT FROM 1")
def f_eqnullsafe(spark, d):
    t = labelled(spark, d)
    return where(t, any_of([Path(t, "toxic").same(F.lit(None)), Path(t, "toxic").same(1)])).select("doc_id", "toxic")


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 40")
def f_gt(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_size") > 40).select("p_partkey", "p_size")


@query("SELECT p_partkey, p_size FROM part WHERE p_size >= 40")
def f_ge(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_size") >= 40).select("p_partkey", "p_size")


@query("SELECT p_partkey, p_size FROM part WHERE p_size < 5")
def f_lt(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_size") < 5).select("p_partkey", "p_size")


@query("SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice <= 1000")
def f_le(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_retailprice") <= 1000).select("p_partkey", "p_retailprice")


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 12")
def f_between(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_size").between(10, 12)).select("p_partkey", "p_size")


@query("SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 7, 49)")
def f_in(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_size").isin([1, 7, 49])).select("p_partkey", "p_size")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL")
def f_isnull(spark, d):
    t = labelled(spark, d)
    return where(t, Path(t, "quality").is_null()).select("doc_id")


@query("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL")
def f_isnotnull(spark, d):
    t = labelled(spark, d)
    return where(t, Path(t, "quality").is_not_null()).select("doc_id", "quality")


@query("SELECT p_partkey, p_brand FROM part WHERE starts_with(p_brand, 'Brand#1')")
def f_prefix(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_brand").startswith("Brand#1")).select("p_partkey", "p_brand")


@query("SELECT p_partkey, p_brand FROM part WHERE suffix(p_brand, '3')")
def f_suffix(spark, d):
    p = read(spark, d, "part")
    return where(p, Path(p, "p_brand").endswith("3")).select("p_partkey", "p_brand")


@query("SELECT doc_id FROM documents WHERE contains(text, 'License')")
def f_contains(spark, d):
    t = read(spark, d, "documents")
    return where(t, Path(t, "text").contains("License")).select("doc_id")


@query("SELECT doc_id FROM documents WHERE contains(text, '*') OR contains(text, '%') OR suffix(text, '?')")
def f_contains_wildcard_literal(spark, d):
    t = read(spark, d, "documents")
    x = Path(t, "text")
    return where(t, any_of([x.contains("*"), x.contains("%"), x.endswith("?")])).select("doc_id")


@query("SELECT p_partkey FROM part WHERE p_name LIKE '%a%1_'")
def f_like(spark, d):
    return where(read(spark, d, "part"), "p_name LIKE '%a%1_'").select("p_partkey")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 1 OR lang = 'fr'")
def f_or(spark, d):
    t = labelled(spark, d)
    return where(t, any_of([Path(t, "toxic") == 1, Path(t, "lang") == "fr"])).select("doc_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0 AND lang = 'fr' AND n_chars > 500")
def f_and(spark, d):
    t = labelled(spark, d)
    return where(t, all_of([Path(t, "toxic") == 0, Path(t, "lang") == "fr", Path(t, "n_chars") > 500])).select("doc_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE NOT (toxic = 1 OR lang = 'fr')")
def f_not_or(spark, d):
    t = labelled(spark, d)
    return where(t, ~any_of([Path(t, "toxic") == 1, Path(t, "lang") == "fr"])).select("doc_id")


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE NOT (toxic = 1)")
def f_not_null(spark, d):
    t = labelled(spark, d)
    return where(t, Path(t, "toxic") != 1).select("doc_id")


@query("SELECT n_nationkey, n_name FROM nation WHERE TRUE AND NOT FALSE")
def f_true_false(spark, d):
    n = read(spark, d, "nation")
    return where(n, call("ALWAYS_TRUE"), ~call("ALWAYS_FALSE")).select("n_nationkey", "n_name")


@query("SELECT n_nationkey, n_name FROM nation")
def f_none(spark, d):
    return where(read(spark, d, "nation")).select("n_nationkey", "n_name")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1996-03-01'")
def f_date_range(spark, d):
    o = read(spark, d, "orders")
    at = Path(o, "o_orderdate")
    return where(o, at >= F.expr("timestamp_ntz'1996-02-01'"), at < F.expr("timestamp_ntz'1996-03-01'")).select("o_orderkey", "o_orderdate")


@query("SELECT event_id, ts FROM events WHERE ts = (SELECT min(ts) FROM events)")
def f_ts_eq(spark, d):
    e = read(spark, d, "events")
    e.createOrReplaceTempView("events_ts_eq")
    return where(e, "ts = (SELECT min(ts) FROM events_ts_eq)").select("event_id", "ts")


@query("SELECT doc_id FROM documents WHERE list_contains(string_split(lower(text), ' '), 'the')")
def f_array_contains(spark, d):
    t = tokens(spark, d)
    return where(t, Path(t, "tokens").has("the")).select("doc_id")


@query("SELECT doc_id FROM documents WHERE NOT list_contains(string_split(lower(text), ' '), 'the')")
def f_not_array_contains(spark, d):
    t = tokens(spark, d)
    return where(t, ~Path(t, "tokens").has("the")).select("doc_id")


@query("SELECT vec_id FROM embeddings WHERE len(list_filter(embedding, lambda x: x > 0.3)) > 0")
def f_array_exists_range(spark, d):
    v = read(spark, d, "embeddings")
    return where(v, Path(v, "embedding") > 0.3).select("vec_id")


@query("SELECT doc_id FROM documents WHERE len(list_filter(string_split(lower(text), ' '), lambda x: starts_with(x, 'tho') OR x IN ('zu', 'los'))) > 0")
def f_array_exists_prefix_in(spark, d):
    t = tokens(spark, d)
    x = Path(t, "tokens")
    return where(t, any_of([x.startswith("tho"), x.isin(["zu", "los"])])).select("doc_id")


@query("SELECT event_id FROM events WHERE json_extract_string(props, '$.k') = '7'")
def f_map_key_eq(spark, d):
    e = tagged(spark, d)
    return where(e, Path(e, "props.k") == "7").select("event_id")


@query("SELECT event_id FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL AND json_extract_string(props, '$.absent') IS NULL")
def f_map_key_present(spark, d):
    e = tagged(spark, d)
    return where(e, Path(e, "props['k']").is_not_null(), Path(e, "props.absent").is_null()).select("event_id")


@query("SELECT event_id FROM events WHERE json_extract_string(props, '$.k') >= '5' AND json_extract_string(props, '$.k') < '6'")
def f_map_key_range(spark, d):
    e = tagged(spark, d)
    k = Path(e, "props.`k`")
    return where(e, k >= "5", k < "6").select("event_id")


@query("SELECT c_custkey, c_acctbal AS balance FROM customer WHERE c_acctbal <= 100 AND c_nationkey <= 12")
def f_struct_leaf_le(spark, d):
    c = customers(spark, d)
    return where(c, Path(c, "who.place.account.balance") <= 100, Path(c, "who.place.nation") <= 12).select("c_custkey", F.col("who.place.account.balance").alias("balance"))


@query("SELECT c_custkey FROM customer WHERE c_acctbal > 9000")
def f_deep_nested(spark, d):
    c = customers(spark, d)
    return where(c, "who.place.account.balance > 9000").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def f_subquery_in(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    return o.join(c.where("c_mktsegment = 'BUILDING'"), o.o_custkey == c.c_custkey, "left_semi").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey < l_suppkey")
def f_col_vs_col(spark, d):
    return where(read(spark, d, "lineitem"), F.col("l_partkey") < F.col("l_suppkey")).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) = 1997")
def f_partition_value(spark, d):
    o = read(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    return where(o, "y = 1997").select("o_orderkey", "y")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice * (1 - l_discount) > 90000 AND length(l_returnflag) = 1")
def f_expression(spark, d):
    return where(read(spark, d, "lineitem"), "l_extendedprice * (1 - l_discount) > 90000 AND length(l_returnflag) = 1").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, big FROM (SELECT c_custkey, c_acctbal > 5000 AS big FROM customer) WHERE big")
def f_bare_boolean(spark, d):
    c = read(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") > 5000).alias("big"))
    return where(c, F.col("big"))


# --- projections ---------------------------------------------------------------------------


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_discount = 0.05")
def p_prune(spark, d):
    return read(spark, d, "lineitem").where("l_discount = 0.05").select("l_orderkey", "l_quantity")


@query("SELECT event_id, 'k' AS first_key, json_extract_string(props, '$.k') AS first_value FROM events")
def p_map_keys_values(spark, d):
    return tagged(spark, d).select("event_id", F.get(F.map_keys("props"), F.lit(0)).alias("first_key"), F.get(F.map_values("props"), F.lit(0)).alias("first_value"))


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e0, CAST(embedding[1000] AS DOUBLE) AS e999 FROM embeddings")
def p_array_item(spark, d):
    v = read(spark, d, "embeddings")
    return v.select("vec_id", Path(v, "embedding[0]").value.cast("double").alias("e0"), Path(v, "embedding[999]").value.cast("double").alias("e999"))


@query("SELECT c_custkey, c_name AS name, c_nationkey AS nation FROM customer")
def p_struct_fields(spark, d):
    c = customers(spark, d)
    return c.select("c_custkey", Path(c, "who.name").value.alias("name"), Path(c, "who.place.nation").value.alias("nation"))


@query("SELECT o_custkey, list_sort(list(o_orderkey)) AS order_keys FROM orders GROUP BY o_custkey")
def p_array_of_struct_field(spark, d):
    o = read(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("orders"))
    return o.select("o_custkey", F.sort_array(Path(o, "orders.o_orderkey").value).alias("order_keys"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * (1 - l_discount), 4) AS net, CASE WHEN l_quantity >= 25 THEN 'many' ELSE 'few' END AS size FROM lineitem")
def p_expressions(spark, d):
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        call("CASE_WHEN", F.col("l_quantity") >= 25, F.lit("many"), F.lit("few")).alias("size"),
    )


# --- aggregates ----------------------------------------------------------------------------


@query("SELECT count(*) AS n FROM lineitem")
def a_count_star(spark, d):
    return aggregate(read(spark, d, "lineitem"), measures={"n": ("count",)})


@query("SELECT count(toxic) AS toxic, count(lang) AS lang, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def a_count_col(spark, d):
    return aggregate(labelled(spark, d), measures={"toxic": ("count", "toxic"), "lang": ("count", "lang"), "n": ("count",)})


@query("SELECT count(*) AS n, count(l_tax) AS n_tax, sum(l_quantity) AS total FROM lineitem WHERE l_quantity < 0")
def a_count_empty(spark, d):
    return aggregate(read(spark, d, "lineitem").where("l_quantity < 0"), measures={"n": ("count",), "n_tax": ("count", "l_tax"), "total": ("sum", "l_quantity")})


@query("SELECT min(p_size) AS lo_int, max(p_size) AS hi_int, min(p_partkey) AS lo_long, max(p_partkey) AS hi_long, min(p_retailprice) AS lo_double, max(p_retailprice) AS hi_double, min(p_name) AS lo_string, max(p_name) AS hi_string FROM part")
def a_min_max(spark, d):
    return aggregate(
        read(spark, d, "part"),
        measures={f"{x}_{k}": (f, c) for k, c in (("int", "p_size"), ("long", "p_partkey"), ("double", "p_retailprice"), ("string", "p_name")) for x, f in (("lo", "min"), ("hi", "max"))},
    )


@query("SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi, CAST(min(o_orderdate) AS DATE) AS lo_day, max(o_totalprice > 1000) AS any_large FROM orders")
def a_min_max_time(spark, d):
    o = read(spark, d, "orders")
    return o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"), F.min(F.to_date("o_orderdate")).alias("lo_day"), F.max(F.col("o_totalprice") > 1000).alias("any_large"))


@query("SELECT CAST(sum(l_linenumber) AS BIGINT) AS sum_int, CAST(sum(l_orderkey) AS BIGINT) AS sum_long, round(sum(l_extendedprice), 2) AS sum_double, round(avg(l_quantity), 6) AS avg_quantity FROM lineitem")
def a_sum_avg(spark, d):
    t = aggregate(read(spark, d, "lineitem"), measures={"sum_int": ("sum", "l_linenumber"), "sum_long": ("sum", "l_orderkey"), "sum_double": ("sum", "l_extendedprice"), "avg_quantity": ("avg", "l_quantity")})
    return t.select("sum_int", "sum_long", F.round("sum_double", 2).alias("sum_double"), F.round("avg_quantity", 6).alias("avg_quantity"))


@query(
    "SELECT l_returnflag, " + ", ".join(f"round({f}(l_quantity), 6) AS {f}" for f in ("var_pop", "var_samp", "stddev_pop", "stddev_samp")) + ", "
    + ", ".join(f"round({f}(l_quantity, l_extendedprice), 6) AS {f}" for f in ("covar_pop", "covar_samp", "corr", "regr_intercept", "regr_r2", "regr_slope")) + ", "
    "round(regr_sxy(l_quantity, l_extendedprice) / 1000000, 6) AS regr_sxy FROM lineitem GROUP BY l_returnflag"
)
def a_stats(spark, d):
    t = statistics(read(spark, d, "lineitem"), "l_quantity", "l_extendedprice", by=["l_returnflag"])
    return t.select("l_returnflag", *[F.round(F.col(c) / 1000000 if c == "regr_sxy" else F.col(c), 6).alias(c) for c in t.columns[1:]])


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, sum(DISTINCT l_linenumber)::BIGINT AS lines FROM lineitem GROUP BY l_returnflag")
def a_distinct(spark, d):
    return aggregate(read(spark, d, "lineitem"), ["l_returnflag"], {"suppliers": ("count_distinct", "l_suppkey"), "lines": ("sum_distinct", "l_linenumber")})


@query("SELECT l_linestatus, count(*) FILTER (WHERE l_quantity > 30) AS many, round(sum(l_tax) FILTER (WHERE l_returnflag = 'R'), 4) AS tax FROM lineitem GROUP BY l_linestatus")
def a_filter_clause(spark, d):
    t = aggregate(read(spark, d, "lineitem"), ["l_linestatus"], {"many": ("count",), "tax": ("sum", "l_tax")}, {"many": "l_quantity > 30", "tax": "l_returnflag = 'R'"})
    return t.withColumn("tax", F.round("tax", 4))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag, l_linestatus")
def a_group_by_multi(spark, d):
    return aggregate(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], {"n": ("count",), "quantity": ("sum", "l_quantity")})


@query("SELECT DISTINCT p_brand, p_type FROM part")
def a_group_only(spark, d):
    return aggregate(read(spark, d, "part"), ["p_brand", "p_type"])


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY year(o_orderdate)")
def a_group_expr(spark, d):
    return read(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))


@query("SELECT json_extract_string(props, '$.k') AS k, count(value) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def a_group_map_key(spark, d):
    t = aggregate(tagged(spark, d), {"k": "props.k"}, {"n": ("count", "value"), "total": ("sum", "value")})
    return t.withColumn("total", F.round("total", 4))


@query("SELECT c_nationkey AS nation, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY c_nationkey")
def a_group_struct_leaf(spark, d):
    return aggregate(customers(spark, d), {"nation": "who.place.nation"}, {"n": ("count",), "top": ("max", "who.place.account.balance")})


@query("SELECT string_split(p_name, ' ') AS words, count(*) AS n FROM part GROUP BY 1")
def a_group_whole_array(spark, d):
    return aggregate(read(spark, d, "part").withColumn("words", F.split("p_name", " ")), ["words"], {"n": ("count",)})


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15")
def a_having(spark, d):
    return aggregate(read(spark, d, "orders"), ["o_custkey"], {"n": ("count",)}).where("n > 15")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def a_rollup(spark, d):
    return aggregate(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], {"n": ("count",)}, grouping="rollup")


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY CUBE (p_brand, p_type)")
def a_cube(spark, d):
    return aggregate(read(spark, d, "part"), ["p_brand", "p_type"], {"n": ("count",)}, grouping="cube")


@query("SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size), ())")
def a_grouping_sets(spark, d):
    read(spark, d, "part").createOrReplaceTempView("part_sets")
    return spark.sql("SELECT p_brand, p_size, count(*) AS n FROM part_sets GROUP BY GROUPING SETS ((p_brand), (p_size), ())")


@query("SELECT max(p_size) + 1 AS a, max(p_size) + 2 AS b FROM part")
def a_shared(spark, d):
    return read(spark, d, "part").agg((F.max("p_size") + 1).alias("a"), (F.max("p_size") + 2).alias("b"))


# --- facets --------------------------------------------------------------------------------

_TOKENS = "SELECT list_distinct(string_split(lower(text), ' ')) AS v, * FROM documents"


@query(f"SELECT unnest(v) AS token, count(*) AS n FROM ({_TOKENS}) GROUP BY 1")
def facet_array(spark, d):
    return facet(tokens(spark, d), {"token": "tokens"})


@query("SELECT token, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS token FROM documents) GROUP BY 1")
def facet_array_explode(spark, d):
    return facet(tokens(spark, d), {"token": "tokens"}, distinct=False)


@query(f"SELECT token, count(*) AS n FROM (SELECT unnest(v) AS token FROM ({_TOKENS}) WHERE lang = 'en' AND list_contains(v, 'the')) GROUP BY 1")
def facet_filtered(spark, d):
    return facet(tokens(spark, d), {"token": "tokens"}, where="lang = 'en' AND array_contains(tokens, 'the')")


@query("""
WITH t AS (SELECT vec_id, label, list_distinct(list_transform(embedding[1:4], lambda x: CAST(floor(x * 10) AS BIGINT))) AS a, list_distinct(list_transform(embedding[5:8], lambda x: CAST(floor(x * 10) AS BIGINT))) AS b FROM embeddings),
     u AS (SELECT unnest(a) AS a, b FROM t)
SELECT a, b, count(*) AS n FROM (SELECT a, unnest(b) AS b FROM u) GROUP BY a, b
""")
def facet_multi(spark, d):
    v = read(spark, d, "embeddings")
    part = lambda first: F.transform(F.slice("embedding", first, 4), lambda x: F.floor(x.cast("double") * 10))
    return facet(v.select(part(1).alias("a"), part(5).alias("b")), ["a", "b"])


@query(f"SELECT token, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, max(n_chars) AS longest FROM (SELECT unnest(v) AS token, n_chars FROM ({_TOKENS})) GROUP BY 1")
def facet_metrics(spark, d):
    return facet(tokens(spark, d), {"token": "tokens"}, {"n": ("count",), "chars": ("sum", "n_chars"), "longest": ("max", "n_chars")})


@query("SELECT json_extract_string(props, '$.k') AS tag, count(*) AS n FROM events GROUP BY 1")
def facet_map_array(spark, d):
    e = tagged(spark, d).select("event_id", F.transform_values("props", lambda k, v: F.array(v, v)).alias("tags"))
    return facet(e, {"tag": "tags.k"})


@query("SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS word FROM part) GROUP BY 1")
def facet_struct_array(spark, d):
    p = read(spark, d, "part").select(F.struct(F.split("p_name", " ").alias("words")).alias("s"))
    return facet(p, {"word": "s.words"})


@query("SELECT x, count(*) AS n FROM (SELECT unnest(list_distinct(list_transform(embedding, lambda e: CAST(floor(e * 4) AS BIGINT)))) AS x FROM embeddings) GROUP BY 1")
def facet_numeric_array(spark, d):
    v = read(spark, d, "embeddings").select(F.transform("embedding", lambda x: F.floor(x.cast("double") * 4)).alias("e"))
    return facet(v, {"x": "e"})


@query("""
WITH t AS (SELECT list_filter(list_distinct(CASE WHEN n_chars < 300 THEN NULL ELSE list_filter(string_split(lower(text), ' '), lambda x: starts_with(x, 'thr')) END), lambda x: x IS NOT NULL) AS v FROM documents)
SELECT token, count(*) AS n FROM (SELECT unnest(v) AS token FROM t WHERE len(v) > 0 UNION ALL SELECT NULL FROM t WHERE v IS NULL OR len(v) = 0) GROUP BY 1
""")
def facet_null_group(spark, d):
    t = tokens(spark, d).select(F.when(F.col("n_chars") >= 300, F.filter("tokens", lambda x: x.startswith("thr"))).alias("few"))
    return facet(t, {"token": "few"})


@query(f"SELECT token, n FROM (SELECT token, count(*) AS n FROM (SELECT unnest(v) AS token FROM ({_TOKENS})) GROUP BY 1) ORDER BY n DESC, token LIMIT 20")
def facet_topk(spark, d):
    return facet(tokens(spark, d), {"token": "tokens"}, top=20)


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def facet_scalar(spark, d):
    return facet(read(spark, d, "documents"), ["lang", "source"])


# --- joins ---------------------------------------------------------------------------------


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY'")
def j_inner(spark, d):
    c = read(spark, d, "customer").where("c_mktsegment = 'MACHINERY'")
    return read(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def j_left(spark, d):
    o = read(spark, d, "orders")
    return read(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT d.doc_id AS doc_id, l.doc_id AS label_id, toxic FROM (SELECT doc_id FROM documents WHERE n_chars > 2000) d FULL JOIN (SELECT * FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id")
def j_full(spark, d):
    docs = read(spark, d, "documents").where("n_chars > 2000").select("doc_id")
    labels = read(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("label_id"), "toxic")
    return docs.join(labels, F.col("doc_id") == F.col("label_id"), "full")


@query("SELECT r_name, n_name FROM nation RIGHT JOIN region ON n_regionkey = r_regionkey")
def j_right(spark, d):
    return read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "right").select("r_name", "n_name")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def j_semi(spark, d):
    o = read(spark, d, "orders").where("o_totalprice > 300000")
    return read(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j_anti(spark, d):
    return read(spark, d, "customer").join(read(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def j_cross(spark, d):
    return read(spark, d, "region").select("r_name").crossJoin(read(spark, d, "nation").select("n_name"))  # 5 and 25 rows at any scale


@query("SELECT a.n_name AS low, b.n_name AS high FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey = b.n_regionkey")
def j_theta(spark, d):
    a = read(spark, d, "nation").select(F.col("n_name").alias("low"), F.col("n_nationkey").alias("lk"), "n_regionkey")
    b = read(spark, d, "nation").select(F.col("n_name").alias("high"), F.col("n_nationkey").alias("hk"), "n_regionkey")
    return a.join(b, "n_regionkey").where("lk < hk").select("low", "high")


@query("""
WITH s AS (SELECT p_partkey, p_retailprice - 1 AS lo, p_retailprice + 1 AS hi FROM part)
SELECT o_orderkey, p_partkey FROM (SELECT o_orderkey, o_totalprice AS price FROM orders) JOIN s ON price >= lo AND price < hi
""")
def j_range(spark, d):
    spans = read(spark, d, "part").select("p_partkey", (F.col("p_retailprice") - 1).alias("lo"), (F.col("p_retailprice") + 1).alias("hi"))
    points = read(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return interval_join(points, spans, "price", "lo", "hi", 2.0).select("o_orderkey", "p_partkey")


@query("""
WITH c AS (SELECT * FROM events WHERE event_type = (SELECT min(event_type) FROM events)),
     p AS (SELECT * FROM events WHERE event_type = (SELECT max(event_type) FROM events))
SELECT c.event_id, max_by(p.event_id, (p.ts, p.event_id)) AS last_event, max_by(p.value, (p.ts, p.event_id)) AS last_value
FROM c LEFT JOIN p ON c.user_id = p.user_id AND p.ts <= c.ts GROUP BY c.event_id
""")
def j_asof(spark, d):
    return _as_of(spark, d, None)


def _as_of(spark, d, chunk):
    e = read(spark, d, "events")
    ends = e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi"))
    e = e.join(F.broadcast(ends))
    left = e.where("event_type = lo").select("event_id", "user_id", "ts")
    right = e.where("event_type = hi").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("last_event"), F.col("value").alias("last_value"))
    return as_of_join(left, right, ["user_id"], "ts", "at", ["last_event", "last_value"], chunk=chunk).select("event_id", "last_event", "last_value")


@query("SELECT doc_id, token FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS token FROM documents WHERE n_chars < 200)")
def j_lateral_explode(spark, d):
    return tokens(spark, d).where("n_chars < 200").select("doc_id", F.explode_outer("tokens").alias("token"))


# --- windows -------------------------------------------------------------------------------


@query("SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd, ntile(4) OVER w AS q FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def w_rank(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return read(spark, d, "orders").select(
        "o_orderkey", F.row_number().over(w).alias("rn"), F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr"),
        F.round(F.percent_rank().over(w), 9).alias("pr"), F.round(F.cume_dist().over(w), 9).alias("cd"), F.ntile(4).over(w).alias("q"),
    )


@query("SELECT event_id, lag(value) OVER w AS before, lead(value) OVER w AS after, first_value(event_id) OVER w AS first_id, last_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_id, nth_value(event_id, 2) OVER w AS second_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def w_lag(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return read(spark, d, "events").select(
        "event_id", F.lag("value").over(w).alias("before"), F.lead("value").over(w).alias("after"), F.first("event_id").over(w).alias("first_id"),
        F.last("event_id").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last_id"), F.nth_value("event_id", 2).over(w).alias("second_id"),
    )


@query("SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving FROM events")
def w_running_sum(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return read(spark, d, "events").select(
        "event_id", F.round(F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)), 4).alias("running"), F.round(F.avg("value").over(w.rowsBetween(-2, 0)), 4).alias("moving")
    )


@query("SELECT event_id, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 3600000000 THEN 1 ELSE 0 END AS fresh FROM events)")
def w_sessions(spark, d):
    return sessions(read(spark, d, "events"), ["user_id"], "ts", 3600, tie=["event_id"]).select("event_id", "session")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def w_top_rows(spark, d):
    return top_rows(read(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def w_tumbling(spark, d):
    t = windowed(read(spark, d, "events"), "ts", "1 hour", by=["event_type"], value="value")
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n", F.round("total", 4).alias("total"))


# --- sets, order, limits -------------------------------------------------------------------


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def s_union_all(spark, d):
    return read(spark, d, "customer").select(F.col("c_nationkey").alias("k")).unionByName(read(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def s_union(spark, d):
    return s_union_all(spark, d).distinct()


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def s_intersect(spark, d):
    c = read(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    return c.intersect(read(spark, d, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
def s_intersect_all(spark, d):
    return read(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersectAll(read(spark, d, "supplier").select("s_nationkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def s_except(spark, d):
    return read(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(read(spark, d, "orders").select("o_custkey"))


@query("SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer")
def s_except_all(spark, d):
    return read(spark, d, "orders").select(F.col("o_custkey").alias("k")).exceptAll(read(spark, d, "customer").select("c_custkey"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o_topk(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 20")
def o_limit_offset(spark, d):
    return read(spark, d, "customer").select("c_custkey").orderBy("c_custkey").offset(20).limit(10)


@query("SELECT doc_id, toxic FROM (SELECT d.doc_id, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) ORDER BY toxic ASC NULLS FIRST, doc_id LIMIT 30")
def o_nulls_first(spark, d):
    return labelled(spark, d).select("doc_id", "toxic").orderBy(F.asc_nulls_first("toxic"), "doc_id").limit(30)


@query()
def o_sample(spark, d):
    """A tenth of the orders, chosen by a seed: the sampling operator itself."""
    return read(spark, d, "orders").sample(fraction=0.1, seed=7).select("o_orderkey")


# --- scalar functions ----------------------------------------------------------------------


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber + 2 AS plus, l_linenumber - 2 AS minus, l_linenumber * 3 AS times, l_quantity / 4 AS over, l_partkey % 7 AS modulo, abs(2 - l_linenumber) AS abs, "
    "round(log10(l_extendedprice), 8) AS log10, round(log2(l_extendedprice), 8) AS log2, round(ln(l_extendedprice), 8) AS ln, round(ln(l_extendedprice) / ln(3), 8) AS log3, round(exp(l_discount), 8) AS exp, round(power(l_quantity, 2), 4) AS pow, "
    "round(sqrt(l_quantity), 8) AS sqrt, CAST(floor(l_extendedprice) AS BIGINT) AS floor, CAST(ceil(l_extendedprice) AS BIGINT) AS ceil, round(cbrt(l_quantity), 8) AS cbrt, CAST(sign(25 - l_quantity) AS DOUBLE) AS sign FROM lineitem"
)
def fn_math(spark, d):
    c = F.col
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        call("+", c("l_linenumber"), 2).alias("plus"), call("-", c("l_linenumber"), 2).alias("minus"), call("*", c("l_linenumber"), 3).alias("times"), call("/", c("l_quantity"), 4).alias("over"),
        call("%", c("l_partkey"), 7).alias("modulo"), call("ABS", 2 - c("l_linenumber")).alias("abs"),
        *[F.round(call(f, c("l_extendedprice")), 8).alias(f.lower()) for f in ("LOG10", "LOG2", "LN")], F.round(call("LOG", F.lit(3.0), c("l_extendedprice")), 8).alias("log3"),
        F.round(call("EXP", c("l_discount")), 8).alias("exp"), F.round(call("POWER", c("l_quantity"), 2), 4).alias("pow"), F.round(call("SQRT", c("l_quantity")), 8).alias("sqrt"),
        call("FLOOR", c("l_extendedprice")).alias("floor"), call("CEIL", c("l_extendedprice")).alias("ceil"), F.round(call("CBRT", c("l_quantity")), 8).alias("cbrt"), call("SIGN", 25 - c("l_quantity")).alias("sign"),
    )


_TRIG = ["SIN", "SINH", "COS", "COSH", "TAN", "TANH", "COT", "ASIN", "ASINH", "ACOS", "ATAN", "ATANH", "DEGREES", "RADIANS"]


@query("SELECT p_partkey, " + ", ".join(f"round({f.lower()}(p_size / 64.0::DOUBLE), 8) AS {f.lower()}" for f in _TRIG) + ", round(acosh(p_size::DOUBLE), 8) AS acosh, round(atan2(p_size::DOUBLE, p_retailprice), 8) AS atan2 FROM part")
def fn_trig(spark, d):
    x = F.col("p_size") / F.lit(64.0)
    return read(spark, d, "part").select(
        "p_partkey", *[F.round(call(f, x), 8).alias(f.lower()) for f in _TRIG], F.round(call("ACOSH", F.col("p_size").cast("double")), 8).alias("acosh"), F.round(call("ATAN2", F.col("p_size").cast("double"), F.col("p_retailprice")), 8).alias("atan2")
    )


@query(
    "SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, substring(p_name, 2, 4) AS sub, translate(p_brand, 'Bd#', 'bD-') AS tr, trim('  ' || p_type || ' ') AS trimmed, ltrim('  ' || p_type) AS lt, rtrim(p_type || '  ') AS rt, "
    "CAST(bit_length(p_name) AS INTEGER) AS bits, CAST(length(p_name) AS INTEGER) AS chars, p_brand || '/' || p_type AS cat, left(p_name, 2) || 'XY' || substring(p_name, 5) AS over, coalesce(nullif(p_type, 'PROMO'), 'none') AS co, "
    "greatest(p_name, p_type) AS hi, least(p_name, p_type) AS lo FROM part"
)
def fn_string(spark, d):
    c = F.col
    return read(spark, d, "part").select(
        "p_partkey", call("UPPER", c("p_name")).alias("up"), call("LOWER", c("p_brand")).alias("low"), call("SUBSTRING", c("p_name"), 2, 4).alias("sub"), call("TRANSLATE", c("p_brand"), "Bd#", "bD-").alias("tr"),
        call("TRIM", F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"), call("LTRIM", F.concat(F.lit("  "), "p_type")).alias("lt"), call("RTRIM", F.concat("p_type", F.lit("  "))).alias("rt"),
        call("BIT_LENGTH", c("p_name")).alias("bits"), call("CHAR_LENGTH", c("p_name")).alias("chars"), call("CONCAT", c("p_brand"), F.lit("/"), c("p_type")).alias("cat"),
        call("OVERLAY", c("p_name"), F.lit("XY"), 3, 2).alias("over"), call("COALESCE", F.nullif("p_type", F.lit("PROMO")), F.lit("none")).alias("co"), call("GREATEST", c("p_name"), c("p_type")).alias("hi"), call("LEAST", c("p_name"), c("p_type")).alias("lo"),
    )


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 10 AS DATE) AS later, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def fn_date(spark, d):
    day = F.to_date("o_orderdate")
    return read(spark, d, "orders").select("o_orderkey", call("DATE_ADD", day, 10).alias("later"), call("DATE_DIFF", day, F.lit("1995-01-01").cast("date")).alias("days"), call("TRUNC", day, "month").alias("month"))


@query("SELECT p_partkey, p_size & 12 AS a, p_size | 12 AS o, xor(p_size, 12) AS x, ~p_size AS n FROM part")
def fn_bit(spark, d):
    s = F.col("p_size")
    return read(spark, d, "part").select("p_partkey", call("&", s, 12).alias("a"), call("|", s, 12).alias("o"), call("^", s, 12).alias("x"), call("~", s).alias("n"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS size, CASE WHEN p_size < 1 THEN 0::BIGINT WHEN p_size >= 50 THEN 8::BIGINT ELSE CAST(floor((p_size - 1) * 7 / 49.0) AS BIGINT) + 1 END AS bucket, round(p_retailprice, 1) AS r FROM part")
def fn_cond(spark, d):
    s = F.col("p_size")
    size = call("CASE_WHEN", s < 10, F.lit("S"), s < 30, F.lit("M"), F.lit("L"))
    return read(spark, d, "part").select("p_partkey", size.alias("size"), call("WIDTH_BUCKET", s.cast("double"), F.lit(1.0), F.lit(50.0), F.lit(7)).alias("bucket"), call("ROUND", F.col("p_retailprice"), 1).alias("r"))


@query("SELECT p_partkey, sha1(p_name) AS sha1, sha256(p_name) AS sha2, md5(p_name) AS md5 FROM part")
def fn_hash(spark, d):
    n = F.col("p_name")
    return read(spark, d, "part").select("p_partkey", call("SHA1", n).alias("sha1"), call("SHA2", n, 256).alias("sha2"), call("MD5", n).alias("md5"))


@query("SELECT p_partkey, p_name AS back, TRUE AS in_range FROM part")
def fn_crypt_rand(spark, d):
    key, n = F.lit("0123456789abcdef"), F.col("p_name")
    back = call("AES_DECRYPT", call("AES_ENCRYPT", n, key), key).cast("string")
    r = call("RAND", 3)
    return read(spark, d, "part").select("p_partkey", back.alias("back"), ((r >= 0) & (r < 1) & (call("CRC32", n) >= 0)).alias("in_range"))


# --- acceptance: nulls, NaN and comparisons -----------------------------------------------


@query("SELECT DISTINCT isnan(x) AS is_nan, x > 1 AS gt, x = 0 AS zero FROM (SELECT CASE p_size % 3 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN -0.0::DOUBLE ELSE p_size::DOUBLE END AS x FROM part)")
def n_nan_order(spark, d):
    p = read(spark, d, "part").select(F.expr("CASE p_size % 3 WHEN 0 THEN double('NaN') WHEN 1 THEN -0.0D ELSE double(p_size) END").alias("x"))
    return p.select(F.isnan("x").alias("is_nan"), (F.col("x") > 1).alias("gt"), (F.col("x") == 0).alias("zero")).distinct()


# --- storage -------------------------------------------------------------------------------


_PLACES: list[tuple] = []


def _place(spark: SparkSession, name: str) -> str:
    """A folder for a table that a query writes: under the folder all executors share, deleted when the driver exits."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sparlode-tables-")
    at = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _PLACES.extend(storage.folder(spark, p) for p in (at, storage.side(at)))
    return at


@atexit.register
def _clean() -> None:
    while _PLACES:
        fs, where = _PLACES.pop()
        try:
            fs.delete(where, True)
        except Exception:  # the JVM is gone, too; the folders are scratch
            pass


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def io_roundtrip(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), at := _place(spark, "roundtrip"))
    return read_index(spark, at).df


@query("SELECT doc_id, n_chars, lang FROM documents WHERE lang = 'de'")
def io_partitioned(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", "n_chars", "lang"), at := _place(spark, "partitioned"), partition_by=["lang"])
    return read_index(spark, at).where("lang = 'de'")


@query("SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE n_chars END AS n_chars FROM documents")
def io_overwrite_by_key(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "n_chars")
    write_index(docs, at := _place(spark, "update"))
    update_by_key(spark, at, docs.where("doc_id % 10 = 0").withColumn("n_chars", F.lit(0).cast("long")), ["doc_id"])
    return read_index(spark, at).df


@query("SELECT doc_id, lang FROM documents")
def io_compact(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", "lang").repartition(6), at := _place(spark, "compact"))
    compact(spark, at, 1)
    return read_index(spark, at).df


@query("SELECT doc_id, lang FROM documents WHERE n_chars > 3000")
def io_sql_path(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", "lang", "n_chars"), at := _place(spark, "sqlpath"))
    return spark.sql(f"SELECT doc_id, lang FROM parquet.`{at}` WHERE n_chars > 3000")


@query("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) = 1998 AND o_totalprice > 100000")
def f_partition_prune(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    write_index(orders, at := _place(spark, "years"), partition_by=["y"])
    return read_index(spark, at).where("y = 1998 AND o_totalprice > 100000")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n, max(o_orderkey) AS last FROM orders GROUP BY 1")
def a_group_partition_col(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    write_index(orders, at := _place(spark, "groups"), partition_by=["y"])
    return aggregate(read_index(spark, at).df, ["y"], {"n": ("count",), "last": ("max", "o_orderkey")})


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id % 2 = 1")
def io_append(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "n_chars")
    write_index(docs.where("doc_id % 2 = 0"), at := _place(spark, "append"))
    write_index(docs.where("doc_id % 2 = 1"), at, mode="append")
    return read_index(spark, at).df


@query("SELECT k AS kind, p_partkey, p_name, p_retailprice FROM part CROSS JOIN (VALUES ('orc'), ('json'), ('csv')) t(k)")
def io_formats(spark, d):
    part, out = read(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), None
    for kind in ("orc", "json", "csv"):
        write_as(part, at := _place(spark, kind), kind)
        one = read_as(spark, at, kind, part.schema).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr')")
def io_ddl_insert(spark, d):
    at = _place(spark, "ddl")
    name = "t_" + at.rsplit("-", 1)[1]
    create_table(spark, name, "doc_id BIGINT, lang STRING", path=at)
    read(spark, d, "documents").where("lang IN ('en', 'fr')").select("doc_id", "lang").write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay where they are
    return spark.read.parquet(at)


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract_string(props, '$.k') = '12'")
def x_shredded_filter(spark, d):
    write_index(tagged(spark, d).select("event_id", "props"), at := _place(spark, "shred"), options=Options(shred={"props": ["k"]}))
    return read_index(spark, at).where("props['k'] = '12'").select("event_id", F.col("props")["k"].alias("k"))


@query(f"SELECT unnest(v) AS token, count(*) AS n FROM ({_TOKENS}) GROUP BY 1")
def x_summary_facet(spark, d):
    write_index(tokens(spark, d).select("doc_id", "tokens"), at := _place(spark, "terms"), options=Options(summarise=["tokens"]))
    return read_index(spark, at).facet({"token": "tokens"})


@query("SELECT count(*) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem")
def x_footer_aggregates(spark, d):
    return footer_read(spark, f"{d}/lineitem.parquet").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))


# --- what has a reader, a writer or a plan of its own --------------------------------------


@query("SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars FROM documents")
def io_user_schema(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", F.col("n_chars").cast("float"), "lang"), at := _place(spark, "schema"))
    return read_index(spark, at, schema="doc_id BIGINT, n_chars FLOAT").df.select("doc_id", F.col("n_chars").cast("double"))


@query("SELECT doc_id FROM documents WHERE lang IN ('de', 'en')")
def io_glob(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", "lang"), at := _place(spark, "glob"), partition_by=["lang"])
    return read_index(spark, at + "/lang={de,en}", name_filter="*.parquet").df.select("doc_id")


@query("SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def io_recursive(spark, d):
    at = _place(spark, "deep")
    write_index(read(spark, d, "customer").select(F.col("c_custkey").alias("k")), at + "/one/here")
    write_index(read(spark, d, "supplier").select(F.col("s_suppkey").alias("k")), at + "/two")
    return read_index(spark, at, recursive=True).df


@query("SELECT s_suppkey FROM supplier")
def io_refresh(spark, d):
    at = _place(spark, "refresh")
    write_index(read(spark, d, "supplier").select("s_suppkey").limit(1), at)
    spark.read.parquet(at).count()
    read(spark, d, "supplier").select("s_suppkey").write.mode("overwrite").parquet(at)  # by another writer
    storage.refresh(spark, at)
    return read_index(spark, at, cache=True).df


@query("SELECT p_partkey, p_name, p_size FROM part")
def io_strict(spark, d):
    write_index(read(spark, d, "part").select("p_partkey", "p_name", "p_size"), at := _place(spark, "strict"), options=Options(strict=True))
    return read_index(spark, at).df


@query("SELECT p_name AS value FROM part")
def io_text(spark, d):
    write_as(read(spark, d, "part").select(F.col("p_name").alias("value")), at := _place(spark, "text"), "text")
    return read_as(spark, at, "text")


@query("SELECT p_partkey, p_name FROM part WHERE p_size > 10")
def io_format_name(spark, d):
    datasource.register(spark)
    at = _place(spark, "named")
    read(spark, d, "part").select("p_partkey", "p_name", "p_size").write.format("sparlode").mode("append").save(at)
    return spark.read.format("sparlode").load(at).where("p_size > 10").select("p_partkey", "p_name")


@query("SELECT lang, count(*) AS n FROM documents WHERE n_chars > 500 GROUP BY lang")
def io_cached(spark, d):
    write_index(read(spark, d, "documents").select("doc_id", "lang", "n_chars"), at := _place(spark, "cached"))
    read_index(spark, at, cache=True).count()
    return read_index(spark, at, cache=True).where("n_chars > 500").groupBy("lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE n_chars END AS n_chars, 1 AS depth FROM documents")
def io_overwrite_by_key_partitioned(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "n_chars", F.coalesce("lang", F.lit("none")).alias("lang"))
    write_index(docs, at := _place(spark, "update_parts"), partition_by=["lang"])
    update_by_key(spark, at, docs.where("doc_id % 10 = 0").withColumn("n_chars", F.lit(0).cast("long")), ["doc_id"])
    return read_index(spark, at).df.select("doc_id", F.nullif("lang", F.lit("none")).alias("lang"), "n_chars").withColumn("depth", F.lit(len(storage.partitions(spark, at))))


@query("SELECT doc_id, lang, 1 AS depth FROM documents WHERE lang IS NOT NULL")
def io_compact_partitioned(spark, d):
    write_index(read(spark, d, "documents").where("lang IS NOT NULL").select("doc_id", "lang").repartition(6), at := _place(spark, "compact_parts"), partition_by=["lang"])
    compact(spark, at)
    return read_index(spark, at).df.withColumn("depth", F.lit(len(storage.partitions(spark, at))))


@query("SELECT user_id, count(*) AS n FROM events WHERE json_extract_string(props, '$.k') = '12' GROUP BY user_id")
def io_sql_accelerated(spark, d):
    write_index(tagged(spark, d).select("user_id", "props"), at := _place(spark, "pathsql"), options=Options(shred={"props": ["k"]}))
    return storage.query(spark, f"SELECT user_id, count(*) AS n FROM sparlode.`{at}` WHERE props['k'] = '12' GROUP BY user_id")


def _summarised(spark, d, name):
    """Events with two tags each, dealt to files by the first, and their summary."""
    tags = tagged(spark, d).select("event_id", "value", F.create_map(F.lit("k"), F.array(F.col("props")["k"]), F.lit("type"), F.array("event_type", F.lit("any"))).alias("tags"))
    options = Options(shred={"tags": ["k", "type"]}, summarise=["tags.k", "tags.type"])
    write_index(tags.repartitionByRange(8, F.col("tags")["k"][0]), at := _place(spark, name), options=options)
    return read_index(spark, at)


@query("SELECT event_id FROM events WHERE json_extract_string(props, '$.k') = '12' AND value > 5")
def x_summary_filter(spark, d):
    return _summarised(spark, d, "filter").where("array_contains(tags.k, '12') AND value > 5").select("event_id")


@query("SELECT t AS type, count(*) AS n FROM (SELECT unnest(list_distinct([event_type, 'any'])) AS t FROM events WHERE json_extract_string(props, '$.k') = '12') GROUP BY 1")
def x_summary_facet_filtered(spark, d):
    return _summarised(spark, d, "facets").facet({"type": "tags.type"}, where="array_contains(tags.k, '12')")


@query("SELECT count(*) FILTER (WHERE json_extract_string(props, '$.k') = '12') AS twelve, count(*) AS present FROM events")
def x_summary_count(spark, d):
    t = _summarised(spark, d, "counts")
    return spark.createDataFrame([(t.count("array_contains(tags.k, '12')"), t.count("tags['k'] IS NOT NULL"))], "twelve long, present long")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def j_broadcast(spark, d):
    return small_join(read(spark, d, "customer"), read(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"]).select("c_custkey", "n_name")


@query("SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey > n_nationkey AND s_acctbal > n_nationkey * 100")
def j_theta_unequal(spark, d):
    s, n = read(spark, d, "supplier"), read(spark, d, "nation")
    return s.join(F.broadcast(n), (s.s_nationkey > n.n_nationkey) & (s.s_acctbal > n.n_nationkey * 100)).select("s_suppkey", "n_nationkey")  # 25 nations, whatever the scale


@query(ORACLES["j_asof"])
def j_asof_chunked(spark, d):
    return _as_of(spark, d, 86_400.0)


@query("SELECT o_orderkey, count(*) OVER w AS n, round(CAST(sum(o_totalprice) OVER w AS DOUBLE), 2) AS total FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) RANGE BETWEEN INTERVAL 90 DAYS PRECEDING AND CURRENT ROW)")
def w_range(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.unix_date(F.to_date("o_orderdate"))).rangeBetween(-90, 0)
    return read(spark, d, "orders").select("o_orderkey", F.count("*").over(w).alias("n"), F.round(F.sum("o_totalprice").over(w).cast("double"), 2).alias("total"))


@query("SELECT l_returnflag, TRUE AS near FROM lineitem GROUP BY 1")
def a_approx_distinct(spark, d):
    t = aggregate(read(spark, d, "lineitem"), ["l_returnflag"], {"about": ("approx_count_distinct", "l_partkey"), "exact": ("count_distinct", "l_partkey")})
    return t.select("l_returnflag", (F.abs(F.col("about") - F.col("exact")) <= 0.15 * F.col("exact")).alias("near"))


@query("SELECT event_type, round(sum(CAST(value AS FLOAT)), 2) AS total, count(*) AS n FROM events GROUP BY 1")
def a_sum_float(spark, d):
    t = aggregate(read(spark, d, "events").withColumn("value", F.col("value").cast("float")), ["event_type"], {"total": ("sum", "value"), "n": ("count",)})
    return t.withColumn("total", F.round("total", 2))


@query("SELECT TRUE AS subset, TRUE AS share, TRUE AS repeatable")
def o_sample_properties(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey")
    one, two = (orders.sample(fraction=0.1, seed=7) for _ in range(2))
    n = F.count("*")
    told = one.agg(n.alias("n"), F.sum(F.xxhash64("o_orderkey").cast("decimal(38,0)")).alias("h")).crossJoin(two.agg(n.alias("n2"), F.sum(F.xxhash64("o_orderkey").cast("decimal(38,0)")).alias("h2")))  # one row each
    told = told.crossJoin(orders.agg(n.alias("total"))).crossJoin(one.join(orders, "o_orderkey", "left_anti").agg(n.alias("strange")))
    return told.select((F.col("strange") == 0).alias("subset"), F.col("n").between(F.col("total") * 0.07, F.col("total") * 0.13).alias("share"), ((F.col("n") == F.col("n2")) & (F.col("h") == F.col("h2"))).alias("repeatable"))


@query("""
SELECT p_partkey, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(p_name) + 1), lambda i: ascii(p_name[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS crc FROM part
""")
def fn_crc32(spark, d):
    return read(spark, d, "part").select("p_partkey", call("CRC32", F.col("p_name")).alias("crc"))


@query("""
SELECT p_partkey, p_type IS NULL AS is_null, p_type IS NOT NULL AS is_not_null, starts_with(p_name, 'b') AS starts, suffix(p_name, 'e') AS ends, contains(p_name, 'an') AS has, p_size IN (1, 2, 3) AS among, p_size = 7 AS eq, p_size <> 7 AS ne, p_size IS NOT DISTINCT FROM 7 AS same,
       p_size < 9 AS lt, p_size <= 9 AS le, p_size > 9 AS gt, p_size >= 9 AS ge, p_size > 9 AND p_size < 20 AS both, p_size < 9 OR p_size > 20 AS either, NOT p_size < 9 AS neither, TRUE AS yes, FALSE AS no FROM part
""")
def v_predicates(spark, d):
    c, n = F.col("p_size"), F.col("p_name")
    return read(spark, d, "part").select(
        "p_partkey", call("IS_NULL", F.col("p_type")).alias("is_null"), call("IS_NOT_NULL", F.col("p_type")).alias("is_not_null"), call("STARTS_WITH", n, "b").alias("starts"), call("ENDS_WITH", n, "e").alias("ends"), call("CONTAINS", n, "an").alias("has"),
        call("IN", c, 1, 2, 3).alias("among"), call("=", c, 7).alias("eq"), call("<>", c, 7).alias("ne"), call("<=>", c, F.lit(7)).alias("same"), call("<", c, 9).alias("lt"), call("<=", c, 9).alias("le"), call(">", c, 9).alias("gt"), call(">=", c, 9).alias("ge"),
        call("AND", c > 9, c < 20).alias("both"), call("OR", c < 9, c > 20).alias("either"), call("NOT", c < 9).alias("neither"), call("ALWAYS_TRUE").alias("yes"), call("ALWAYS_FALSE").alias("no"),
    )


# --- streams: files of a folder as they come, until all are read ----------------------------


def _streamed(spark, d, name, make):
    """The result of a streaming query over four files of events, read one at a time."""
    source, out = _place(spark, name), _place(spark, name + "-out")
    e = read(spark, d, "events").withColumn("tags", F.array("event_type", "event_type", F.lit(None)))
    e.repartition(4).write.parquet(source)
    result = make(read_stream(spark, source, e.schema, files_per_trigger=1))
    running = result.writeStream.outputMode("complete").option("checkpointLocation", _place(spark, name + "-state")).trigger(availableNow=True).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).start()
    running.awaitTermination()
    return spark.read.schema(result.schema).parquet(out)


def _ntz(t, *columns):
    return t.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(ORACLES["w_tumbling"])
def st_tumbling(spark, d):
    t = _streamed(spark, d, "tumbling", lambda s: windowed(s, "ts", "1 hour", late="9999 days", by=["event_type"], value="value"))
    return _ntz(t, "window_start", "window_end").withColumn("total", F.round("total", 4))


_SLIDING = "SELECT w AS window_start, w + INTERVAL 2 hours AS window_end, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 hour, ts), time_bucket(INTERVAL 1 hour, ts) - INTERVAL 1 hour]) AS w FROM events) GROUP BY ALL"


@query(_SLIDING)
def w_sliding(spark, d):
    return _ntz(windowed(read(spark, d, "events"), "ts", "2 hours", "1 hour"), "window_start", "window_end")


@query(_SLIDING)
def st_sliding(spark, d):
    return _ntz(_streamed(spark, d, "sliding", lambda s: windowed(s, "ts", "2 hours", "1 hour", late="9999 days")), "window_start", "window_end")


_SESSIONS = """
WITH t AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 2 hours THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
     u AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM t)
SELECT min(ts) AS session_start, max(ts) + INTERVAL 2 hours AS session_end, user_id, count(*) AS n FROM u GROUP BY user_id, k
"""


@query(_SESSIONS)
def w_session_windows(spark, d):
    return _ntz(session_windows(read(spark, d, "events"), "ts", "2 hours", by=["user_id"]), "session_start", "session_end")


@query(_SESSIONS)
def st_sessions(spark, d):
    return _ntz(_streamed(spark, d, "sessions", lambda s: session_windows(s, "ts", "2 hours", late="9999 days", by=["user_id"])), "session_start", "session_end")


@query("SELECT time_bucket(INTERVAL 1 day, ts) AS window_start, time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day AS window_end, event_type AS value, count(*) AS n FROM events GROUP BY ALL")
def st_facets(spark, d):
    return _ntz(_streamed(spark, d, "facets", lambda s: facet_stream(s, "tags", "ts", "1 day", late="9999 days")), "window_start", "window_end")
