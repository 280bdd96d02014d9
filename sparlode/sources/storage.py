"""Tables as Parquet folders, with optional accelerators beside them.

A table is a plain Parquet folder: partition discovery, footers, pushdown and pruning are
Spark's, and any other reader can use it. Next to it, `<path>.side` holds what write_index
derived: `about` (the shredded keys and their columns, the summarised paths, how files are
written, and a fingerprint of the files described), `terms` (the summary, by file) and `files`.
An accelerator is used only while the fingerprint is that of the table's files. Appending
describes the new files alone.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types as gate
from ..operators.facets import facet
from ..paths import free_name, quote
from ..plans import shredding, summary
from ..plans.cache import registry


def folder(spark: SparkSession, path: str) -> tuple:
    """A path's file system and the path, as JVM objects."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = folder(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = folder(spark, path)
    fs.delete(where, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, where = folder(spark, old)
    if not fs.rename(where, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")


def side(path: str) -> str:
    return path.rstrip("/") + ".side"


@dataclass
class Options:
    """strict: refuse types that the gate doesn't know. compression and row_group_mb go to the Parquet writer.

    shred: map column -> keys that get a column of their own. summarise: paths whose values
    are counted per file, for facets without a filter, counts and filters on values.
    """

    strict: bool = False
    compression: str = "zstd"
    row_group_mb: int = 128
    shred: Mapping[str, Iterable[str]] = field(default_factory=dict)
    summarise: Iterable[str] = ()


def write_index(df: DataFrame, path: str, mode: str = "error", partition_by: Iterable[str] = (), options: Options | None = None, sort_by: Iterable[str] = ()) -> None:
    """Write a table. mode: error, overwrite, append or ignore, as in Spark; partition_by makes `column=value` folders.

    sort_by sorts each file, which tightens its row groups' minima and maxima. Appending to a
    table keeps its shredded keys and its summary; update_by_key and compact keep everything.
    """
    options, spark = options or Options(), df.sparkSession
    if options.strict:
        gate.check(df.schema)
    if mode == "ignore" and exists(spark, path):
        return
    old = _side(spark, path) if mode == "append" else None
    if old:
        about = old | {"summarised": list(dict.fromkeys([*old["summarised"], *options.summarise]))}
    else:
        layout = {"compression": options.compression, "row_group_mb": options.row_group_mb, "sort_by": list(sort_by)}
        about = {"shred": shredding.named(df.columns, options.shred), "summarised": list(options.summarise), "layout": layout}
    _write(shredding.shred(df, about["shred"]), path, mode, list(partition_by), about["layout"] | ({"sort_by": list(sort_by)} if sort_by else {}))
    registry.invalidate(path)
    _describe(spark, path, about, old)


def _write(df: DataFrame, path: str, mode: str, partition_by: list[str], layout: Mapping, **more: str) -> None:
    if layout["sort_by"]:
        df = df.sortWithinPartitions(*partition_by, *layout["sort_by"])
    writer = df.write.mode(mode).option("compression", layout["compression"]).option("parquet.block.size", layout["row_group_mb"] << 20).options(**more)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of a table's files, listed by Spark; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length", "modificationTime")


def _fingerprint(files: DataFrame) -> str:
    """Tells sets of files apart by how many there are and a sum of hashes of name, size and time."""
    n, total = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{n}:{total}"


def _describe(spark: SparkSession, path: str, about: dict, old: dict | None = None) -> None:
    """Write what stands beside the table; given what stood there before, only files that are new are read."""
    fields, default = about["summarised"], Options()
    plain = about["layout"] == {"compression": default.compression, "row_group_mb": default.row_group_mb, "sort_by": []}
    if not about["shred"] and not fields and plain:
        delete(spark, side(path))
        return
    files = _files(spark, path)
    read = {f: shredding.rewrite_path(f, about["shred"]) for f in fields}
    known = spark.read.parquet(side(path) + "/files") if old and old["summarised"] == fields and fields else None
    if known is not None and known.join(files, known.columns, "left_anti").isEmpty():
        fresh = files.join(known, known.columns, "left_anti").select(*known.columns).toArrow()
        new = fresh["path"].to_pylist()
        if new:
            summary.build(spark.read.option("basePath", path).parquet(*new), read).write.mode("append").parquet(side(path) + "/terms")
            spark.createDataFrame(fresh).write.mode("append").parquet(side(path) + "/files")
    else:
        delete(spark, side(path))
        if fields:
            summary.build(spark.read.parquet(path), read).write.mode("overwrite").parquet(side(path) + "/terms")
            files.write.mode("overwrite").parquet(side(path) + "/files")
    told = json.dumps(about | {"fingerprint": _fingerprint(files)})
    spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(side(path) + "/about")


def _side(spark: SparkSession, path: str) -> dict | None:
    if not exists(spark, side(path) + "/about"):
        return None
    return json.loads("".join(r[0] for r in spark.read.text(side(path) + "/about").collect()))


#: Most files that a filter on summarised values may name to the scan; beyond that, the scan's own statistics must do.
MOST_FILES = 10_000
#: Different values, and values a row has on average, up to which a facet counts whole sets of values first.
FEW_VALUES, FEW_EACH = 1000, 8


class Table:
    """A table that was read: `df` is the plain DataFrame; where, count and facet use the accelerators while they are current."""

    def __init__(self, spark: SparkSession, path: str, df: DataFrame, about: dict | None, cached: bool = False):
        self.spark, self.path, self.about, self.cached = spark, path, about, cached
        self.stored = df
        current = about is not None and about["fingerprint"] == _fingerprint(_files(spark, path))
        self.keys: dict[str, dict[str, str]] = about["shred"] if current else {}
        self.summarised: list[str] = about["summarised"] if current else []
        hidden = [h for keys in (about["shred"] if about else {}).values() for h in keys.values()]
        self.df = df.drop(*hidden)
        self._few: dict[str, bool] = {}

    def _terms(self) -> DataFrame:
        """The summary, kept in memory from its first use on."""
        return registry.get(self.spark, side(self.path) + "/terms", version=self.about["fingerprint"])

    def _rows(self, predicate: str) -> DataFrame:
        """The stored columns of the rows for which the predicate is true; only files whose summary has its values are read."""
        source = self.stored
        if self.summarised and not self.cached:
            tests = [t for t in (summary.condition(c, self.df.schema, self.summarised) for c in summary.conjuncts(predicate)) if t is not None]
            if tests:
                named = [r["file"] for r in summary.files_with(self._terms(), tests).limit(MOST_FILES + 1).collect()]
                if not named:
                    source = source.limit(0)
                elif len(named) <= MOST_FILES and len(named) < int(self.about["fingerprint"].split(":")[0]):
                    source = self.spark.read.schema(source.schema).option("basePath", self.path).parquet(*named)
        return source.where(shredding.rewrite(predicate, self.keys))

    def where(self, predicate: str) -> DataFrame:
        """Rows for which the SQL predicate is true.

        Map keys with a column of their own are read, and pushed down, from it. Files without
        the values that a conjunct `array_contains(path, x)`, `path = x`, `path IN (...)` or
        `path IS NOT NULL` on a summarised path asks for are not opened.
        """
        return self._rows(predicate).select(*[F.col(quote(c)) for c in self.df.columns])

    def count(self, predicate: str | None = None) -> int:
        """How many rows there are, or for how many the predicate is true; from the summary where it can tell."""
        if predicate is None:
            return self.stored.count()
        test = summary.condition(predicate, self.df.schema, self.summarised)
        if test is not None:
            return self._terms().where(test).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return self._rows(predicate).count()

    def facet(self, paths: Iterable[str] | Mapping[str, str], measures: Mapping[str, tuple[str, ...]] | None = None, distinct: bool = True, where: str | None = None, top: int | None = None) -> DataFrame:
        """facet() of the table: from the summary without a filter; by whole sets of values where the summary shows these to be few."""
        named = dict(paths) if isinstance(paths, Mapping) else {p: p for p in paths}
        if distinct and where is None and measures is None and top is None and len(named) == 1 and next(iter(named.values())) in self.summarised:
            (out, path), = named.items()
            return summary.facet(self._terms(), path, out, self.df.schema)
        inner = {n: shredding.rewrite_path(p, self.keys) for n, p in named.items()}
        source = self.stored if where is None else self._rows(where)
        return facet(source, inner, measures, distinct, top=top, pregroup=distinct and all(self._has_few(p) for p in named.values()))

    def _has_few(self, path: str) -> bool:
        if path not in self.summarised:
            return False
        if path not in self._few:
            terms = self._terms().where((F.col("field") == path) & (F.col("kind") == "term"))
            values, listed, none = terms.agg(F.count_distinct("term"), F.sum("n"), F.sum(F.when(F.col("term").isNull(), F.col("n")).otherwise(0))).first()
            present = self._terms().where((F.col("field") == path) & (F.col("kind") == "present")).agg(F.sum("n")).first()[0]
            self._few[path] = values <= FEW_VALUES and (listed or 0) - (none or 0) <= FEW_EACH * max(1, present or 0)
        return self._few[path]


def query(spark: SparkSession, text: str) -> DataFrame:
    """An SQL query whose tables may be paths, as sparlode.`path`; paths to shredded keys in it are read from their columns."""
    hidden: list[str] = []
    keys: dict[str, dict[str, str]] = {}
    views: list[str] = []

    def view(m: re.Match) -> str:
        table = read_index(spark, m[1])
        for c, listed in table.keys.items():
            if listed != keys.setdefault(c, listed):
                raise ValueError(f"two tables keep keys of {c} in different columns: query them by read_index")
        hidden.extend(set(table.stored.columns) - set(table.df.columns))
        views.append(f"sparlode_{uuid.uuid4().hex}")
        table.stored.createOrReplaceTempView(views[-1])
        return views[-1]

    out = spark.sql(shredding.rewrite(re.sub(r"\bsparlode\.`([^`]+)`", view, text), keys))
    for v in views:  # the plan is resolved and doesn't need them
        spark.catalog.dropTempView(v)
    return out.drop(*hidden)


def read_index(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, merge_schema: bool = False, recursive: bool = False, name_filter: str | None = None, cache: bool = False
) -> Table:
    """Read a table or glob. The schema comes from the footers unless one is given.

    recursive reads all folders below and then has no partition columns; a folder that is
    partitioned refuses it, as the two readings contradict each other. cache keeps the table in
    memory from the first use on, for later reads of the path too, until it is written or refreshed.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    paths = [path] if isinstance(path, str) else list(path)
    if len(paths) == 1 and not any(c in paths[0] for c in "*?[{"):
        recover(spark, paths[0])
    if recursive:
        for p in paths:
            fs, where = folder(spark, p)
            if fs.exists(where) and any("=" in s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()):
                raise ValueError(f"{p} is partitioned: recursive lookup would lose its partition columns")
        reader = reader.option("recursiveFileLookup", "true")
    cache = cache and len(paths) == 1 and schema is None and not (merge_schema or recursive or name_filter)
    df = registry.get(spark, paths[0]) if cache else reader.parquet(*paths)
    about = _side(spark, paths[0]) if len(paths) == 1 and schema is None and not any(c in paths[0] for c in "*?[{") else None
    return Table(spark, paths[0], df, about, cache)


def refresh(spark: SparkSession, path: str) -> None:
    """Forget what was cached or listed of a table whose files changed behind Spark's back."""
    spark.catalog.refreshByPath(path)
    registry.invalidate(path)


def create_table(spark: SparkSession, name: str, ddl: str, path: str | None = None, partition_by: Iterable[str] = ()) -> None:
    """CREATE TABLE with a column list as in SQL; insert with df.write.insertInto(name) or INSERT INTO."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{parts}{place}")


def partitions(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a table, from its folders."""
    fs, where = folder(spark, path)
    found: list[str] = []
    while True:
        below = next((s.getPath() for s in fs.listStatus(where) if s.isDirectory() and "=" in s.getPath().getName()), None)
        if below is None:
            return found
        found.append(unquote(below.getName().split("=", 1)[0]))
        where = below


def _about(spark: SparkSession, path: str) -> dict:
    default = Options()
    return _side(spark, path) or {"shred": {}, "summarised": [], "layout": {"compression": default.compression, "row_group_mb": default.row_group_mb, "sort_by": []}}


def update_by_key(spark: SparkSession, path: str, changes: DataFrame, keys: Iterable[str], partition_by: Iterable[str] | None = None) -> None:
    """Replace the rows whose keys occur in changes, and add those that are new. Null keys are equal to each other; changes may have a key once.

    The table keeps its partitions (partition_by can name them) and how it is written. A
    partitioned table whose partition columns are among the keys has only the touched
    partitions rewritten; else the table is written anew beside the old one and takes its
    place when complete.
    """
    keys = list(keys)
    recover(spark, path)
    partition_by = partitions(spark, path) if partition_by is None else list(partition_by)
    if not changes.groupBy(*keys).agg(F.count("*").alias(n := free_name(keys, "_n"))).where(F.col(n) > 1).isEmpty():
        raise ValueError(f"changes have a key twice: {keys}")
    about, table = _about(spark, path), read_index(spark, path)
    old = table.df

    def matched(rows: DataFrame, others: DataFrame, by: list[str], how: str) -> DataFrame:
        others = others.select(*[F.col(quote(k)).alias(f"_k{i}") for i, k in enumerate(by)]).distinct()
        return rows.join(others, reduce(and_, [rows[quote(k)].eqNullSafe(others[f"_k{i}"]) for i, k in enumerate(by)]), how)

    partly = bool(partition_by) and set(partition_by) <= set(keys)
    if partly:
        old = matched(old, changes, partition_by, "left_semi")
    kept = matched(old, changes, keys, "left_anti")
    new = shredding.shred(kept.unionByName(changes.select(*[F.col(quote(c)) for c in old.columns])), about["shred"])
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    _write(new, staged, "overwrite", partition_by, about["layout"])
    if partly:
        _write(spark.read.parquet(staged), path, "overwrite", partition_by, about["layout"], partitionOverwriteMode="dynamic")
        delete(spark, staged)
    else:
        _swap(spark, staged, path)
    refresh(spark, path)
    _describe(spark, path, {k: about[k] for k in ("shred", "summarised", "layout")})


def compact(spark: SparkSession, path: str, files: int = 1, partition_by: Iterable[str] | None = None) -> None:
    """Write a table anew in so many files (for each partition, where it has some); its partitions and how it is written stay."""
    recover(spark, path)
    partition_by = partitions(spark, path) if partition_by is None else list(partition_by)
    about, df = _about(spark, path), spark.read.parquet(path)
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    if partition_by:
        salt = F.pmod(F.xxhash64(*[F.col(quote(c)) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]), F.lit(files))
        df = df.repartition(*[F.col(quote(c)) for c in partition_by], salt)
    else:
        df = df.repartition(files)
    _write(df, staged, "error", partition_by, about["layout"])
    _swap(spark, staged, path)
    refresh(spark, path)
    _describe(spark, path, {k: about[k] for k in ("shred", "summarised", "layout")})


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a complete table in another's place; `recover` finishes what breaks off in between."""
    rename(spark, staged, ready := path.rstrip("/") + ".ready")
    delete(spark, path)
    rename(spark, ready, path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement that broke off: a complete table waits beside its place as `<path>.ready`."""
    ready = path.rstrip("/") + ".ready"
    if exists(spark, ready):
        delete(spark, path)
        rename(spark, ready, path)
        refresh(spark, path)
