import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparlode import aggregate, facet
from sparlode.operators.predicates import Path, all_of, any_of, where
from sparlode.paths import column, leaves, parse, type_at
from sparlode.types import check, facet_schema, unsupported

from .fixtures import typed


def ids(df):
    return sorted(r.CustomerID for r in df.collect())


@pytest.mark.parametrize("path, steps", [("a.b", ["a", "b"]), ("m.`0.3`", ["m", "0.3"]), ("m['0.3']", ["m", "0.3"]), ("`Customer ID`", ["Customer ID"]), ("a[2].b", ["a", 2, "b"]), ("s.`x``y`", ["s", "x`y"])])
def test_parse(path, steps):
    assert parse(path) == steps


def test_bad_paths(spark):
    for bad in ("", "a..b", "a[", "a['b"):
        with pytest.raises(ValueError):
            parse(bad)
    t = typed(spark)
    for bad in ("nothing", "StructInfo.nothing", "CustomerID.x"):
        with pytest.raises(ValueError):
            column(t.schema, bad)


def test_filter_on_map_key_date_and_array(spark):
    t = typed(spark)
    assert ids(where(t, "MapInfo.color = 'red' AND (Day > '2023-05-29' AND array_contains(ArrayInfo, '3'))")) == ["CA873"]
    assert ids(where(t, Path(t, "MapInfo.color") == "red", Path(t, "ArrayInfo").has("3"))) == ["CA873"]
    assert ids(where(t, Path(t, "MapInfo.`0.3`") == "1")) == ["CA871", "CA872"]


def test_three_valued_logic(spark):
    t = spark.createDataFrame([(1, 2), (None, 2), (3, None)], "a int, b int")
    a, b = Path(t, "a"), Path(t, "b")
    n = lambda *p: where(t, *p).count()
    assert n(any_of([a == 1, b == 2])) == 2 and n(~any_of([a == 1, b == 2])) == 0 and n(~(a == 1)) == 1 and n(a != 1) == 1
    assert n(a.same(F.lit(None))) == 1 and n(F.lit(True)) == 3 and n(F.lit(False)) == 0 and n() == 3
    assert n(all_of([])) == 3 and n(any_of([])) == 0 and n(a.is_null()) == 1
    e = spark.createDataFrame([(["x", None],), (["y"],), ([],), (None,)], "v array<string>")
    v = Path(e, "v")
    assert where(e, ~v.has("x")).count() == 2 and where(e, ~v.has("z")).count() == 2 and where(e, v.is_null()).count() == 1


def test_existential_on_arrays_and_null_keys(spark):
    t = typed(spark)
    assert ids(where(t, Path(t, "MapArray.sport") == "tennis")) == ["CA871"]
    assert ids(where(t, Path(t, "StructInfo.map_tags").startswith("basket"))) == ["CA869", "CA871"]
    assert ids(where(t, Path(t, "MapArray.sport").is_null())) == ["CA872", "CA873"]
    assert ids(where(t, Path(t, "MapArray").is_null())) == ["CA873"]
    m = spark.createDataFrame([({"k": None, "j": "1"},), ({"j": "2"},)], "m map<string,string>")
    assert where(m, Path(m, "m.k").is_null()).count() == 2 and m.where("map_contains_key(m, 'k')").count() == 1


def test_struct_leaves_at_any_depth(spark):
    t = spark.sql("SELECT named_struct('b', named_struct('c', named_struct('d', id))) a, map('x', named_struct('y', id)) m FROM range(5)")
    assert where(t, Path(t, "a.b.c.d") <= 2).count() == 3 and where(t, Path(t, "m.x.y") <= 1).count() == 2
    typed_ = typed(spark)
    assert ids(where(typed_, Path(typed_, "StructInfo.age") <= 30)) == ["CA869", "CA870"]


def test_literal_wildcards(spark):
    t = spark.createDataFrame([("a*b",), ("a?b",), ("a\\b",), ("50%",), ("x_y",), ("axb",)], "s string")
    s = Path(t, "s")
    for x in ("*", "?", "\\", "%", "_"):
        assert where(t, s.contains(x)).count() == 1
    assert where(t, s.endswith("*b")).count() == 1 and where(t, s.startswith("a*")).count() == 1


def test_nan_zero_and_bounds(spark):
    t = spark.createDataFrame([(float("nan"), 2147483647, True), (0.0, 1, False), (-0.0, -2147483648, None)], "x double, i int, b boolean")
    assert where(t, Path(t, "x") > 1).count() == 1 and where(t, Path(t, "x") == 0).count() == 2
    assert where(t, Path(t, "i") > 2147483647).count() == 0 and where(t, Path(t, "b") >= False).count() == 2


def test_aggregates_of_every_type(spark):
    t = typed(spark)
    row = aggregate(t.where("CustomerID = 'none'"), measures={"n": ("count",), "d": ("count", "Day"), "s": ("sum", "StandardPackage")}).first()
    assert (row.n, row.d, row.s) == (0, 0, None)
    for c in t.columns:
        assert aggregate(t, measures={"n": ("count", c)}).first().n == t.where(F.col(c).isNotNull()).count()
    for c in ("StandardPackage", "Day", "isDeleted", "CustomerName", "Timestamp", "ExtraOption2"):
        r = aggregate(t, measures={"lo": ("min", c), "hi": ("max", c)}).first()
        values = [x[0] for x in t.select(c).collect() if x[0] is not None]
        assert (r.lo, r.hi) == (min(values), max(values))
    assert round(aggregate(t, measures={"s": ("sum", "ExtraOption2")}).first().s, 2) == 7400.08


def test_group_by_nested_and_arrays(spark):
    t = typed(spark)
    got = {r.color: (r.n, r.s) for r in aggregate(t, {"color": "MapInfo.color"}, {"n": ("count", "ExtraOption3"), "s": ("sum", "ExtraOption3")}).collect()}
    assert got == {None: (1, 1350.05), "yellow": (0, None), "blue": (0, None), "red": (1, 1350.06)}
    assert {tuple(r.ArrayInfo): r.n for r in aggregate(t, ["ArrayInfo"], {"n": ("count",)}).collect()} == {("1", "2", "3"): 4, ("1", "2", "3", "4"): 1}
    with pytest.raises(TypeError):
        aggregate(t, measures={"s": ("sum", "ArrayInfo")})
    with pytest.raises(ValueError):
        aggregate(t, measures={"s": ("median", "ExtraOption3")})


def test_sum_overflow_is_an_error(spark):
    t = spark.createDataFrame([(2**63 - 1,), (1,)], "x long")
    with pytest.raises(Exception, match="overflow"):
        aggregate(t, measures={"s": ("sum", "x")}).collect()


def counts(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.n for r in df.collect()}


def test_facets(spark):
    t = typed(spark)
    assert counts(facet(t, {"v": "ArrayInfo"}), "v") == {"1": 5, "2": 5, "3": 5, "4": 1}
    assert counts(facet(t, {"v": "MapArray.sport"}), "v") == {"football": 3, "basketball": 2, "tennis": 1, None: 2}
    assert counts(facet(t, {"v": "StructInfo.map_tags"}), "v") == {"football": 3, "basketball": 2, "tennis": 1, None: 2}


def test_facet_duplicates_and_nulls(spark):
    t = spark.createDataFrame([(["a", "a", None], 1), ([], 2), (None, 3), ([None], 4)], "v array<string>, x int")
    assert counts(facet(t, ["v"]), "v") == {None: 3, "a": 1}
    assert counts(facet(t, ["v"], distinct=False), "v") == {None: 4, "a": 2}
    got = {r.v: (r.n, r.s) for r in facet(t, ["v"], {"n": ("count",), "s": ("sum", "x")}).collect()}
    assert got == {"a": (1, 1), None: (3, 9)}
    with pytest.raises(TypeError):
        facet(t, ["v"], {"s": ("sum", "v")})


def test_facets_multiply(spark):
    t = spark.createDataFrame([([1, 2], ["x", "y", "x"]), ([], ["x"])], "a array<int>, b array<string>")
    assert counts(facet(t, ["a", "b"]), "a", "b") == {(1, "x"): 1, (1, "y"): 1, (2, "x"): 1, (2, "y"): 1, (None, "x"): 1}
    assert [r.b for r in facet(t, ["b"], top=1).collect()] == ["x"]


def test_schema_helpers(spark):
    schema = typed(spark).schema
    assert dict(leaves(schema))["MapArray.*"] == T.StringType() and dict(leaves(schema))["StructInfo.age"] == T.IntegerType()
    flat = facet_schema(schema)
    assert flat["ArrayInfo"].dataType == T.StringType() and flat["MapArray"].dataType.valueType == T.StringType()
    assert flat["StructInfo"].dataType["map_tags"].dataType == T.StringType()
    assert type_at(schema, "MapArray.sport") == T.ArrayType(T.StringType())
    check(schema)
    odd = T.StructType([T.StructField("d", T.DecimalType(5, 2)), T.StructField("s", T.StructType([T.StructField("b", T.ArrayType(T.BinaryType()))]))])
    assert unsupported(odd) == ["d: decimal(5,2)", "s.b: binary"]
    with pytest.raises(TypeError):
        check(odd)


def test_struct_leaf_is_pushed_down(spark, tmp_path):
    typed(spark).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = where(t, Path(t, "StructInfo.age") <= 30).select("CustomerID")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(StructInfo.age,30)" in plan
