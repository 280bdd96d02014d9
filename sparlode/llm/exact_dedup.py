"""Exact deduplication as a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition is a run: its rows' digests, sorted, with one identifier per digest.
Runs merge in binomial rounds (`fan_in` runs become one, again and again). Each round is a
shuffle by (run, digest), so a merged run stays spread over the cluster by digest, and a text
that a third of all rows share sends at most one row per run into the next round. The
decisions go back down the same tree: a digest with copies meets at most `fan_in` children
in each round, so no join key ever gathers a hot text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

KEY = ["digest", "n_bytes", "witness"]


def normalised(text: Column) -> Column:
    """Texts are compared as they stand; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def digest_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: the run it lies in and what identifies its text.

    Besides SHA-256, the byte length and an independent 64-bit hash are part of the key, so
    two texts merge only if all three agree: this is the check that a digest match is real.
    """
    text = normalised(F.col(f"`{text_col}`"))
    return docs.select(
        F.spark_partition_id().cast("long").alias("run"),
        F.col(f"`{id_col}`").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("witness"),
    )


def exact_dedup(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fan_in: int = 16
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    keep is "min" or "max": which identifier of equal texts stays. Null texts are empty
    texts and so are equal to each other. Rows with a null id lose to any row that has one;
    a group without any id keeps all its rows (keep_id null). Rows repeated under one id
    stand for one row: each is counted in group_size and marked alike. An empty table gives
    an empty result; other columns are ignored.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    best = F.min if keep == "min" else F.max
    scratch = Scratch(spark, "exact")
    leaf = scratch.put(digest_runs(docs, id_col, text_col), "leaf")
    level = leaf.groupBy("run", *KEY).agg(best("id").alias("keep_id"), F.count("*").alias("n"))
    levels = [level]
    runs = leaf.agg(F.max("run")).first()[0] or 0
    while runs:
        runs //= fan_in
        level = scratch.put(
            level.withColumn("run", F.floor(F.col("run") / fan_in)).groupBy("run", *KEY).agg(best("keep_id").alias("keep_id"), F.sum("n").alias("n")),
            f"up{len(levels)}",
        )
        levels.append(level)
    # Down again: only digests with copies travel, one level at a time.
    down = level.where("n > 1")
    for below in reversed(levels[:-1]):
        child = below.select(F.col("run").alias("child"), F.floor(F.col("run") / fan_in).alias("run"), *KEY)
        down = child.join(down, ["run", *KEY]).select(F.col("child").alias("run"), *KEY, "keep_id", "n")
    found = leaf.join(down, ["run", *KEY], "left")
    alone = F.col("n").isNull()
    keep_id = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The documents with one row per text; columns stay as they are.

    A row without an id goes if its text has a row with one. Rows repeated under one id with
    one text come out once, and so does a text that has only rows without an id; which of
    such rows stays is settled by a hash of their columns.
    """
    sha = F.sha2(normalised(F.col(f"`{text_col}`")), 256)
    marks = exact_dedup(spark, docs, id_col, text_col, keep).groupBy(F.col(id_col).alias("_i"), F.col("text_sha256").alias("_s")).agg(F.first("kept").alias("_kept"), F.count("*").alias("_n"))
    fate = Scratch(spark, "exact").put(marks.where("NOT _kept OR _n > 1"), "fate")

    def same(other: DataFrame):
        return docs[id_col].eqNullSafe(other["_i"]) & (sha == other["_s"])

    repeated = fate.where("_kept")
    once = docs.join(fate, same(fate), "left_anti")
    if repeated.isEmpty():
        return once
    plain = [F.col(f"`{f.name}`") for f in docs.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    line = Window.partitionBy(F.col(f"`{id_col}`"), sha).orderBy(F.xxhash64(*plain))
    number = "_" * (1 + max(map(len, docs.columns)))
    chosen = docs.join(repeated, same(repeated), "left_semi").withColumn(number, F.row_number().over(line)).where(F.col(number) == 1).drop(number)
    return once.unionByName(chosen)
