import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparlode import as_of_join, interval_join, read_index, statistics, write_index
from sparlode.functions.vocabulary import FUNCTIONS, PREDICATES, call
from sparlode.operators.windows import sessions, top_rows
from sparlode.plans.session import SETTINGS, session
from sparlode.sources.storage import Options
from sparlode.streaming.windows import facet_stream, read_stream, session_windows, windowed


def test_as_of(spark):
    l = spark.createDataFrame([(1, 5, "a"), (1, 1, "b"), (2, 9, "c"), (1, None, "d")], "k int, t int, x string")
    r = spark.createDataFrame([(1, 2, 10), (1, 5, 20), (1, 5, 30), (2, 10, 40), (1, None, 50)], "k int, t int, v int")
    for chunk in (None, 1, 3, 100):
        got = {x.x: x.v_right for x in as_of_join(l, r, ["k"], "t", "t", ["v"], suffix="_right", chunk=chunk).collect()}
        assert got == {"a": 30, "b": None, "c": None, "d": None}


def test_as_of_in_pieces(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    right = e.where("event_id % 3 = 0").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("last"))
    whole = sorted(map(str, as_of_join(e, right, ["user_id"], "ts", "at", ["last"]).collect()))
    assert whole == sorted(map(str, as_of_join(e, right, ["user_id"], "ts", "at", ["last"], chunk=86400).collect()))


def test_interval(spark):
    p = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.5, 9.99, 10.0, -3.0)], "x double")
    s = spark.createDataFrame([(0.0, 10.0), (2.0, 3.0), (-4.0, -3.0), (-3.0, 0.0), (5.0, 5.0)], "lo double, hi double")
    for width in (0.5, 1.0, 100.0):
        got = sorted((r.x, r.lo) for r in interval_join(p, s, "x", "lo", "hi", width).collect())
        assert got == [(-3.0, -3.0), (0.0, 0.0), (1.0, 0.0), (2.5, 0.0), (2.5, 2.0), (9.99, 0.0)]


def test_sessions(spark):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    t = spark.createDataFrame([(1, at(0)), (1, at(5)), (1, at(16)), (2, at(3))], "k int, t timestamp")
    assert sorted((r.k, r.t.second, r.session) for r in sessions(t, ["k"], "t", 10).collect()) == [(1, 0, 0), (1, 5, 0), (1, 16, 1), (2, 3, 0)]


def test_columns_named_like_internal_ones(spark):
    t = spark.createDataFrame([(1, 5, 7, 8.0), (1, 6, 9, 8.5)], "_t int, _rank int, _new int, _bucket double")
    assert top_rows(t, ["_t"], [F.desc("_rank")], 1).collect()[0].asDict() == {"_t": 1, "_rank": 6, "_new": 9, "_bucket": 8.5}
    timed = t.withColumn("at", F.timestamp_seconds("_rank"))
    assert [(r._new, r.session) for r in sessions(timed, ["_t"], "at", 10).orderBy("_new").collect()] == [(7, 0), (9, 0)]
    right = t.select("_t", F.col("_rank").alias("at"), F.col("_new").alias("_right"))
    got = as_of_join(t, right, ["_t"], "_rank", "at", ["_right"], chunk=1)
    assert sorted((r._rank, r._new, r._right) for r in got.collect()) == [(5, 7, 7), (6, 9, 9)]
    spans = spark.createDataFrame([(8.0, 8.2, "x")], "lo double, hi double, name string")
    assert [(r._bucket, r.name) for r in interval_join(t, spans, "_bucket", "lo", "hi", 1.0).collect()] == [(8.0, "x")]


def test_vocabulary():
    assert len(FUNCTIONS) == 64 and len(PREDICATES) == 18
    with pytest.raises(ValueError):
        call("NO_SUCH")


def test_statistics_of_few_rows(spark):
    r = statistics(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), "x", "y").first()
    assert r.var_pop == 0.0 and r.var_samp is None and r.covar_samp is None


def test_session_helper(spark):
    s = session(spark__sql__shuffle__partitions="8")
    assert s.conf.get("spark.sql.adaptive.enabled") == SETTINGS["spark.sql.adaptive.enabled"]


def test_streams(spark, tmp_path, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("tags", F.array("event_type", "event_type"))
    at = str(tmp_path / "events")
    e.repartition(4).write.parquet(at)
    stream = read_stream(spark, at, e.schema, files_per_trigger=1)
    for name, make in (
        ("tumbling", lambda d: windowed(d, "ts", "1 day", late="999 days", by=["event_type"], value="value")),
        ("sliding", lambda d: windowed(d, "ts", "2 days", "1 day", late="999 days")),
        ("sessions", lambda d: session_windows(d, "ts", "2 hours", late="999 days", by=["user_id"])),
        ("facets", lambda d: facet_stream(d, "tags", "ts", "1 day", late="999 days")),
    ):
        q = make(stream).writeStream.outputMode("complete").format("memory").queryName(f"s_{name}").start()
        q.processAllAvailable()
        q.stop()
        want = make(spark.read.parquet(at))
        got = spark.table(f"s_{name}")
        drop = [c for c in got.columns if c != "total"]
        assert sorted(map(str, got.select(drop).collect())) == sorted(map(str, want.select(drop).collect()))


_leaf = st.sampled_from(["m.k = '1'", "m['k'] IS NULL", "m.j >= '2'", "array_contains(a, 'x')", "exists(a, v -> v > 'x')", "n <= 2", "n <=> NULL", "s.f BETWEEN 1 AND 2", "m.`0.3` IN ('1', '3')", "TRUE", "s.f <> 1"])
_tree = st.recursive(_leaf, lambda t: st.one_of(t.map(lambda x: f"NOT ({x})"), st.tuples(t, st.sampled_from(["AND", "OR"]), t).map(lambda x: f"({x[0]} {x[1]} {x[2]})")), max_leaves=6)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [(i, {k: v for k, v in (("k", str(i % 3)), ("j", str(i % 5)), ("0.3", str(i % 4))) if (i >> len(k)) % 2}, None if i % 7 == 0 else [x for x in ("x", "y", None) if (i + len(x or "")) % 2], None if i % 6 == 0 else i % 4, None if i % 5 == 0 else (i % 3,)) for i in range(60)]
    plain = spark.createDataFrame(rows, "id int, m map<string,string>, a array<string>, n int, s struct<f: int>").cache()
    at = str(tmp_path_factory.mktemp("random") / "t")
    write_index(plain, at, options=Options(shred={"m": ["k", "j", "0.3"]}))
    return plain, read_index(spark, at)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_tree)
def test_random_predicates_agree_on_both_layouts(stored, predicate):
    plain, table = stored
    assert sorted(r.id for r in table.where(predicate).collect()) == sorted(r.id for r in plain.where(predicate).collect())
