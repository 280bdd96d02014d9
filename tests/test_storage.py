import pytest
from pyspark.sql import functions as F

from sparlode import compact, facet, query, read_index, update_by_key, write_index
from sparlode.operators.joins import small_join
from sparlode.plans import shredding, summary
from sparlode.plans.cache import CacheRegistry, registry
from sparlode.plans.session import FOOTER_AGGREGATES, configure, footer_read
from sparlode.sources import datasource
from sparlode.sources.storage import Options, create_table, partitions, refresh

from .fixtures import DDL, tags, typed


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_round_trip_with_partitions(spark, tmp_path):
    at, t = str(tmp_path / "t"), typed(spark)
    write_index(t, at, mode="overwrite", partition_by=["ImpDay"], options=Options(strict=True))
    same(read_index(spark, at).df, t)
    same(read_index(spark, at, schema=DDL).df, t)
    pruned = read_index(spark, at).where("ImpDay = 20230529")
    assert pruned.count() == 2 and "PartitionFilters: [isnotnull(ImpDay" in pruned._jdf.queryExecution().executedPlan().toString()
    same(spark.sql(f"SELECT * FROM parquet.`{at}` WHERE MapInfo.color = 'red'"), t.where("MapInfo.color = 'red'"))
    with pytest.raises(ValueError):
        read_index(spark, at, recursive=True)
    same(read_index(spark, at + "/ImpDay=2023*").df.select("CustomerID"), t.select("CustomerID"))


def test_modes(spark, tmp_path):
    at, t = str(tmp_path / "m"), spark.range(3)
    write_index(t, at)
    with pytest.raises(Exception, match="already exists"):
        write_index(t, at)
    write_index(spark.range(99), at, mode="ignore")
    write_index(spark.range(3, 5), at, mode="append")
    assert sorted(r.id for r in read_index(spark, at).df.collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(TypeError):
        write_index(spark.sql("SELECT 1.5BD AS d"), at, mode="overwrite", options=Options(strict=True))


def test_names_with_spaces(spark, tmp_path):
    at = str(tmp_path / "spaces")
    t = spark.sql("SELECT 1 AS `Customer ID`, map('a b', 'x') AS `Map Info`, 'é' AS `Größe`")
    write_index(t, at, options=Options(shred={"Map Info": ["a b"]}))
    same(read_index(spark, at).df, t)
    assert read_index(spark, at).where("`Map Info`['a b'] = 'x' AND `Customer ID` = 1").count() == 1


def test_table_ddl_and_insert(spark):
    spark.sql("DROP TABLE IF EXISTS sparlode_test_table")
    create_table(spark, "sparlode_test_table", "id bigint, k string", partition_by=["k"])
    spark.sql("SELECT 1L AS id, 'a' AS k").write.insertInto("sparlode_test_table")
    spark.sql("INSERT INTO sparlode_test_table VALUES (2, 'b')")
    assert sorted(tuple(r) for r in spark.table("sparlode_test_table").collect()) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE sparlode_test_table")


@pytest.mark.parametrize("predicate", [
    "map_tags['sports'] IS NOT NULL", "array_contains(map_tags.sports, 'sports-1')", "map_tags.`sports` IS NULL OR size(map_tags.art) > 3",
    "NOT array_contains(map_tags.sports, 'sports-1')", "map_tags['sports'][0] = 'sports-1'", "'map_tags.sports' = 'map_tags.sports' AND age < 10", "map_contains_key(map_tags, 'sports')",
])
def test_shredded_equals_plain(spark, tmp_path, predicate):
    at, t = str(tmp_path / "s"), tags(spark)
    write_index(t, at, options=Options(shred={"map_tags": ["sports", "art"]}))
    table = read_index(spark, at)
    assert table.df.columns == t.columns
    same(table.where(predicate.replace("[0]", "[0]")), t.where(predicate))


def test_shredded_key_is_pushed_down(spark, tmp_path):
    at = str(tmp_path / "p")
    write_index(typed(spark), at, options=Options(shred={"MapInfo": ["color", "0.3"]}))
    plan = read_index(spark, at).where("MapInfo.color = 'red' AND MapInfo.`0.3` IS NULL")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(MapInfo__color,red)" in plan and "IsNull(MapInfo__0_2e_3)" in plan


def test_rewrite():
    keys = shredding.named(["m", "x"], {"m": ["k", "0.3"]})
    assert shredding.rewrite("m.k = 'm.k' AND m['0.3'] > 1 AND x.m.k = 2 AND m.other = m.`k`", keys) == "`m__k` = 'm.k' AND `m__0_2e_3` > 1 AND x.m.k = 2 AND m.other = `m__k`"
    assert shredding.rewrite("f(m) + 1.5", keys) == "f(m) + 1.5"


def test_summary_facets_and_staleness(spark, tmp_path):
    at, t = str(tmp_path / "f"), tags(spark).select("user_id", F.col("map_tags")["sports"].alias("sports"), "occupation")
    write_index(t.repartition(3), at, options=Options(summarise=["sports", "occupation"]))
    table = read_index(spark, at)
    assert table.summarised == ["sports", "occupation"]
    same(table.facet({"v": "sports"}), facet(t, {"v": "sports"}))
    same(table.facet(["occupation"]), facet(t, ["occupation"]))
    same(table.facet({"v": "sports"}, where="occupation = 1"), facet(t.where("occupation = 1"), {"v": "sports"}))
    t.limit(10).write.mode("append").parquet(at)  # behind the engine's back
    stale = read_index(spark, at)
    assert stale.summarised == [] and stale.facet({"v": "sports"}).agg(F.sum("n")).first()[0] > table.facet({"v": "sports"}).agg(F.sum("n")).first()[0]


@pytest.mark.parametrize("partitioned", [False, True])
def test_update_by_key(spark, tmp_path, partitioned):
    at, by = str(tmp_path / "u"), ["p"] if partitioned else []
    t = spark.range(20).select("id", F.lit("old").alias("v"), (F.col("id") % 3).cast("int").alias("p"))
    write_index(t, at, partition_by=by)
    changes = spark.createDataFrame([(4, "new", 1), (100, "new", 1)], "id long, v string, p int")
    update_by_key(spark, at, changes, ["id", "p"], by)
    got = {r.id: r.v for r in read_index(spark, at).df.collect()}
    assert got == {i: "old" for i in range(20)} | {4: "new", 100: "new"}


def test_compact(spark, tmp_path):
    at = str(tmp_path / "c")
    write_index(spark.range(100).withColumn("p", F.col("id") % 2).repartition(10), at, partition_by=["p"], options=Options(summarise=["id"]))
    compact(spark, at, 1, ["p"])
    table = read_index(spark, at)
    assert len(table.df.inputFiles()) == 2 and table.df.count() == 100 and table.summarised == ["id"]


def test_cache_registry(spark, tmp_path):
    at = str(tmp_path / "r")
    write_index(spark.range(5), at)
    assert registry.get(spark, at).count() == registry.get(spark, at).count() == 5 and registry.hits >= 1
    write_index(spark.range(7), at, mode="overwrite")
    assert registry.get(spark, at).count() == 7
    refresh(spark, at)
    small = CacheRegistry(most=1)
    for n in "ab":
        spark.range(2).write.parquet(str(tmp_path / n))
        small.get(spark, str(tmp_path / n))
    assert len(small.held) == 1
    small.clear()


def test_footer_aggregates_and_settings_restored(spark, tmp_path):
    at = str(tmp_path / "a")
    write_index(spark.range(50), at)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with configure(spark, FOOTER_AGGREGATES):
        out = spark.read.parquet(at).agg(F.count("*"), F.min("id"), F.max("id"))
        assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in out._jdf.queryExecution().executedPlan().toString()
        assert tuple(out.first()) == (50, 0, 49)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_format_name(spark, tmp_path):
    datasource.register(spark)
    at, t = str(tmp_path / "ds"), typed(spark).drop("Timestamp")
    t.write.format("sparlode").mode("append").save(at)
    same(spark.read.format("sparlode").schema(t.schema).load(at), t)
    same(spark.read.format("sparlode").option("path", at).load().select("CustomerID"), t.select("CustomerID"))
    t.limit(2).write.format("sparlode").mode("overwrite").save(at)
    assert spark.read.format("sparlode").schema(t.schema).load(at).count() == 2
    with configure(spark, {"spark.sql.python.filterPushdown.enabled": "true"}):
        assert spark.read.format("sparlode").schema(t.schema).option("push", "true").load(at).where("StandardPackage IS NULL AND CustomerID >= 'CA870'").count() == 1


def test_hidden_columns_leave_the_users_own_alone(spark, tmp_path):
    at = str(tmp_path / "clash")
    t = spark.sql("SELECT map('k', 'v') AS m, 'mine' AS m__k, 'too' AS M__K_")
    write_index(t, at, options=Options(shred={"m": ["k"]}))
    same(read_index(spark, at).df, t)
    assert read_index(spark, at).where("m.k = 'v' AND m__k = 'mine'").count() == 1
    same(query(spark, f"SELECT * FROM sparlode.`{at}` WHERE m['k'] = 'v'"), t)
    assert "EqualTo(m__k__,v)" in query(spark, f"SELECT m__k FROM sparlode.`{at}` WHERE m['k'] = 'v'")._jdf.queryExecution().executedPlan().toString()


def test_append_describes_only_new_files(spark, tmp_path, monkeypatch):
    at, t = str(tmp_path / "grow"), tags(spark).select("user_id", F.col("map_tags")["sports"].alias("sports"))
    write_index(t, at, options=Options(summarise=["sports"]))
    read, build = [], summary.build
    monkeypatch.setattr(summary, "build", lambda df, fields: read.append(df.count()) or build(df, fields))
    for _ in range(2):
        write_index(t.limit(3), at, mode="append")
    write_index(t.limit(2), at, mode="append", options=Options(summarise=["sports"]))
    assert read == [3, 3, 2]
    table = read_index(spark, at)
    assert table.summarised == ["sports"]
    same(table.facet({"v": "sports"}), facet(table.df, {"v": "sports"}))


def test_filters_open_only_files_with_the_value(spark, tmp_path):
    at = str(tmp_path / "skip")
    t = spark.range(100).select("id", F.array(F.concat(F.lit("v"), (F.col("id") % 10).cast("string")), F.lit(None)).alias("a"), (F.col("id") % 10).cast("int").alias("n"), F.when(F.col("id") < 7, F.lit("x")).alias("s"))
    write_index(t.repartitionByRange(10, "n"), at, options=Options(summarise=["a", "n", "s"]))
    table = read_index(spark, at)
    files = len(table.df.inputFiles())
    for predicate, n in (("array_contains(a, 'v3')", 1), ("n = 3 AND id > 50", 1), ("n IN (3, 4) AND array_contains(a, 'v4')", 1), ("array_contains(a, 'no')", 0), ("n = 3 OR n = 4", files), ("s = 'x' AND n BETWEEN 0 AND 9", files)):
        out = table.where(predicate)
        assert len(out.inputFiles()) == n if n else out.isEmpty()
        same(out, t.where(predicate))
        same(table.facet({"v": "a"}, where=predicate), facet(t.where(predicate), {"v": "a"}))
    for predicate in ("array_contains(a, 'v3')", "n = 3", "n IN (3, 4, 4)", "s IS NOT NULL", "a IS NOT NULL", "s = 'y'", "n > 3"):
        assert table.count(predicate) == t.where(predicate).count()
    assert table.count() == 100


def test_conjuncts():
    assert summary.conjuncts("a = 'x AND y' AND f(b AND c) and d['AND'] = 1") == ["a = 'x AND y'", "f(b AND c)", "d['AND'] = 1"]
    assert summary.conjuncts("a BETWEEN 1 AND k = 'a'") == ["a BETWEEN 1 AND k = 'a'"]
    assert summary.conjuncts("a IS NOT NULL AND b = 1") == ["a IS NOT NULL", "b = 1"]


def test_layout_is_kept(spark, tmp_path):
    at = str(tmp_path / "layout")
    t = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("p"), F.lit("old").alias("v"))
    write_index(t.repartition(4), at, partition_by=["p"], options=Options(compression="gzip"), sort_by=["id"])
    update_by_key(spark, at, spark.createDataFrame([(3, 1, "new"), (77, 0, "new")], "id long, p int, v string"), ["id"])
    assert partitions(spark, at) == ["p"] and all(".gz." in f for f in read_index(spark, at).df.inputFiles())
    compact(spark, at)
    assert len(read_index(spark, at).df.inputFiles()) == 2 and ".gz." in read_index(spark, at).df.inputFiles()[0]
    assert {r.id: r.v for r in read_index(spark, at).df.collect()} == {i: "old" for i in range(40)} | {3: "new", 77: "new"}


def test_null_and_repeated_keys(spark, tmp_path):
    at = str(tmp_path / "nulls")
    write_index(spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string"), at)
    for v in ("c", "d"):
        update_by_key(spark, at, spark.createDataFrame([(None, v)], "k int, v string"), ["k"])
    assert sorted(((r.k, r.v) for r in read_index(spark, at).df.collect()), key=str) == sorted([(None, "d"), (1, "b")], key=str)
    with pytest.raises(ValueError):
        update_by_key(spark, at, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])


def test_recovery(spark, tmp_path):
    at = str(tmp_path / "broken")
    write_index(spark.range(3), at)
    write_index(spark.range(5), at + ".ready")  # a replacement that broke off before it took its place
    assert read_index(spark, at).df.count() == 5 and read_index(spark, at).df.count() == 5


def test_cached_reads(spark, tmp_path):
    at, t = str(tmp_path / "warm"), tags(spark)
    write_index(t, at, options=Options(shred={"map_tags": ["sports"]}, summarise=["map_tags.sports"]))
    for _ in range(2):
        same(read_index(spark, at, cache=True).where("array_contains(map_tags.sports, 'sports-1')"), t.where("array_contains(map_tags.sports, 'sports-1')"))
    same(read_index(spark, at, cache=True).facet({"v": "map_tags.sports"}, where="age > 0"), facet(t.where("age > 0"), {"v": "map_tags.sports"}))
    write_index(t.limit(1), at, mode="overwrite")
    assert read_index(spark, at, cache=True).count() == 1


def test_footer_read_keeps_the_pushdown(spark, tmp_path):
    at = str(tmp_path / "foot")
    write_index(spark.range(50), at)
    out = footer_read(spark, at).agg(F.count("*").alias("n"), F.max("id").alias("hi"))
    for use in (out, out.select("hi"), out.where("n > 1"), out.withColumn("x", F.lit(1))):
        assert "PushedAggregation: [" in use._jdf.queryExecution().executedPlan().toString() and "PushedAggregation: []" not in use._jdf.queryExecution().executedPlan().toString()
    assert tuple(out.first()) == (50, 49)


def test_small_join(spark):
    small = spark.range(3).withColumnRenamed("id", "k")
    big = spark.range(10).select((F.col("id") % 5).alias("k"))
    for most, plan in ((10, "BroadcastHashJoin"), (2, "SortMergeJoin")):
        out = small_join(big, small, ["k"], most_rows=most)
        assert plan in out._jdf.queryExecution().executedPlan().toString() and out.count() == 6
