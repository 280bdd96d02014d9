"""SetSketch near-duplicate detection.

A sketch holds `registers` exponentially spaced, truncated minima: register i is
floor(1 - log_b(x_i)) clipped to 0..q+1, where x_i is the smallest exponential variate that
hash function i gives to any element. Registers merge by maximum and two sets agree in a
register with a probability close to their Jaccard similarity (b is close to 1), so runs of
registers serve as bands. Documents that share a band are compared: first by the likelihood
of their registers together with the two known cardinalities, then on their full sets.

With 128 registers in 32 bands of 4, a pair at similarity 0.75 shares no band with a chance
of (1 - 0.75**4)**32 = 5e-6; at 0.8, 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, wide
from .components import connected_components
from .shingles import shingles, word_hashes

BASE, RATE, TOP = 1.001, 20.0, 65534
REGISTERS, BAND = 128, 4
#: A pair whose estimate lies more than this below the threshold isn't verified: 6.5 standard errors of 128 registers, a chance of 4e-11.
SLACK = 0.25
_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(elements), 2048):
        part = elements[i : i + 2048, None] * _A[None, :] + _B[None, :]
        np.minimum(low, part.min(axis=0), out=low)
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1.0 - np.log(np.maximum(x, 1e-300)) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


_GRID = np.linspace(0.0, 1.0, 101)


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs (rows) from how their registers compare and both sizes."""
    above = (a > b).sum(axis=1)[:, None]
    below = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - above - below
    u = (size_a / (size_a + size_b))[:, None]
    v = 1.0 - u
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))

    def p(x):
        return np.maximum(-np.log1p(-np.maximum(x, 0.0) * (BASE - 1) / BASE) / np.log(BASE), 1e-9)

    up, down = p(u - v * j), p(v - u * j)
    likely = above * np.log(up) + below * np.log(down) + equal * np.log(np.maximum(1.0 - up - down, 1e-9))
    return j[np.arange(len(j)), likely.argmax(axis=1)]


def set_digest(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set; zeros for the empty one."""
    digest = hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else bytes(16)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


SKETCHES = "id long, n long, hi long, lo long, registers binary"


def _sketch_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches, 2000):
        ids, out = batch.column(0), ([], [], [], [])
        for text in batch.column(1):
            found = shingles(word_hashes(text.as_py()), width)
            for column, value in zip(out, (len(found), *set_digest(found), sketch(found).tobytes() if len(found) else b"")):
                column.append(value)
        yield pa.record_batch([ids, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())], names=["id", "n", "hi", "lo", "registers"])


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int = 5) -> DataFrame:
    """(id, n, hi, lo, registers): set size, 128-bit digest of the set, sketch."""
    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    return source.mapInArrow(lambda it: _sketch_rows(it, width), SKETCHES)


def bands(classes: DataFrame) -> DataFrame:
    """(key, id, n): a row per band of each class; the key hashes the band's number and registers."""
    step = 2 * BAND
    keys = F.transform(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)), lambda i: F.xxhash64(i, F.substring(F.col("registers"), i * step + 1, F.lit(step))))
    return classes.select(F.explode(keys).alias("key"), "id", "n")


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, where what is made of a row is larger than the row."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The sets of classes' first members; of several texts under one id only the one that the class stands for counts."""
    for batch in _sliced(batches):
        found = [shingles(word_hashes(t.as_py()), width) for t in batch.column(1)]
        own = pa.array([set_digest(x) == (h, l) for x, h, l in zip(found, batch.column(3).to_pylist(), batch.column(4).to_pylist())], pa.bool_())
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array([x.tobytes() for x in found], pa.binary())], names=["id", "registers", "elements"]).filter(own)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in _sliced(batches):
        a, b, ea, eb, ra, rb = (batch.column(k) for k in ("a", "b", "elements_a", "elements_b", "registers_a", "registers_b"))
        rx, ry = (np.frombuffer(b"".join(r.to_pylist()), dtype="<u2").reshape(-1, REGISTERS) for r in (ra, rb))
        sets = [[np.frombuffer(e.as_buffer(), dtype=np.uint64) for e in column] for column in (ea, eb)]
        likely = joint_estimate(rx, ry, *(np.array([len(x) for x in column]) for column in sets)) >= percent / 100 - SLACK
        mask = pa.array([bool(l) and linked(x, y, percent) for l, x, y in zip(likely, *sets)], pa.bool_())
        yield pa.record_batch([a.filter(mask), b.filter(mask)], names=["a", "b"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("registers").alias("registers_a"), F.col("elements").alias("elements_a"))
    right = sets.select(F.col("id").alias("b"), F.col("registers").alias("registers_b"), F.col("elements").alias("elements_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.mapInArrow(lambda it: _verified(it, percent), "a long, b long")


def band_pairs(keys: np.ndarray, queries: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, target, bands shared) of all queries and targets, given by row, that share a band; in order of query and target."""
    found = [np.zeros(0, dtype=np.int64)]
    for column in keys.T:
        order = targets[np.argsort(column[targets], kind="stable")]
        first, last = (np.searchsorted(column[order], column[queries], side) for side in ("left", "right"))
        many = last - first
        at = np.arange(int(many.sum())) + np.repeat(first - np.cumsum(many) + many, many)
        found.append(np.repeat(queries, many) * len(keys) + order[at])
    pair, shared = np.unique(np.concatenate(found), return_counts=True)
    return pair // len(keys), pair % len(keys), shared


def _links_in_block(table: pa.Table, percent: int) -> pa.Table:
    """Links between the queries and the targets of one block that join components.

    A query meets the targets it shares a band with, likeliest first, and is verified on the
    full sets. A target whose component is joined already needs no more links.
    """
    ids, comp, query = table["id"].to_numpy(), table["component"].to_numpy(), table["query"].to_numpy()
    regs = np.frombuffer(b"".join(table["registers"].to_pylist()), dtype="<u2").reshape(-1, REGISTERS)
    bands_of = np.ascontiguousarray(regs).view("<u8")  # a band is four registers of two bytes
    sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for c in table["elements"].chunks for x in c]
    size = np.array([len(x) for x in sets])
    root = {c: c for c in np.unique(comp).tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    found = ([], [])
    of, with_, _ = band_pairs(bands_of, np.flatnonzero(query), np.flatnonzero(~query))
    fit = (comp[of] != comp[with_]) & (100 * np.minimum(size[of], size[with_]) >= percent * np.maximum(size[of], size[with_]))
    of, with_ = of[fit], with_[fit]
    for part in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
        if not len(part):
            continue
        q, near = int(of[part[0]]), with_[part]
        likely = joint_estimate(regs[near], np.broadcast_to(regs[q], (len(near), REGISTERS)), size[near], np.full(len(near), size[q]))
        for k in np.argsort(-likely, kind="stable"):
            if likely[k] < percent / 100 - SLACK:
                break
            t = near[k]
            one, other = find(int(comp[q])), find(int(comp[t]))
            if one != other and linked(sets[q], sets[t], percent):
                root[max(one, other)] = min(one, other)
                found[0].append(int(ids[q]))
                found[1].append(int(ids[t]))
    return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})


def residual_links(member: DataFrame, sets: DataFrame, component: DataFrame, percent: int, block: int = 1024, in_blocks=None) -> DataFrame:
    """Links between rows that share a band but not yet a component, enough to join all that belong together.

    Buckets within one component need nothing. Of any other bucket, the rows outside its
    largest component are queries against all its rows. Buckets with the same largest
    component are taken together, so a row is sent once for all its bands, in blocks of a
    bounded number of targets and queries. Pairs are compared where they meet and only links
    are returned, at most one for two components and block. in_blocks, if given, finds the links
    in rows that come one block after the other.
    """
    placed = member.join(component.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    by_comp = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    mains = by_comp.groupBy("key").agg(F.max(F.struct("c", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("key", F.col("main.component").alias("main"))
    rows = placed.join(mains, "key").select("main", "id", "component", (F.col("component") != F.col("main")).alias("query")).distinct()
    size = rows.groupBy("main").agg(F.ceil(F.count("*") / block).alias("cuts"), F.ceil(F.count_if("query") / (block // 4)).alias("parts"))
    rows = rows.join(size, "main")
    cut, part = F.pmod(F.xxhash64("id"), F.col("cuts")), F.pmod(F.xxhash64("id"), F.col("parts"))

    def each(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    targets = rows.select("main", cut.alias("cut"), each("parts").alias("part"), "id", "component", F.lit(False).alias("query"))
    queries = rows.where("query").select("main", each("cuts").alias("cut"), part.alias("part"), "id", "component", "query")
    # As many tasks as the session's setting: rows are few but costly, so small partitions must not be joined.
    blocks = targets.unionByName(queries).join(sets, "id").repartition(wide(member.sparkSession), "main", "cut", "part")
    if in_blocks:
        return blocks.sortWithinPartitions("main", "cut", "part").mapInArrow(lambda it: in_blocks(it, percent), "a long, b long")
    return blocks.groupBy("main", "cut", "part").applyInArrow(lambda t: _links_in_block(t, percent), "a long, b long")


def near_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Documents are linked when the Jaccard similarity of their sets of `width`-word shingles
    is at least `percent` / 100; every link is confirmed on the full sets. component_id is
    the smallest id reachable by links, kept marks the row that has it. Texts without a word
    (null and empty ones too) have an empty set and are linked with nothing. Rows with equal
    sets are one class and are compared once. Rows repeated under one id are one document
    and share its links. Rows without an id are counted but linked with nothing (null
    component, kept). An empty table gives an empty result; other columns are ignored.
    """
    scratch = Scratch(spark, "near")
    every = scratch.put(sketches(docs, id_col, text_col, width), "sketches")
    grouped = every.where("n > 0 AND id IS NOT NULL").groupBy("hi", "lo").agg(F.min(F.struct("id", "n", "registers")).alias("r"), F.count("*").alias("copies"))
    classes = scratch.put(grouped.select("hi", "lo", "copies", "r.id", "r.n", "r.registers"), "classes")
    band = bands(classes)
    first = band.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("c")).where("c > 1").select("key", "first")
    member = scratch.put(band.join(first, "key").select("key", "id", "n", "first"), "members")
    wanted = member.select("id").distinct()
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    chosen = classes.select("id", "registers", "hi", "lo").join(wanted, "id")
    sets = scratch.put(texts.join(chosen, "id").select("id", "text", "registers", "hi", "lo").mapInArrow(lambda it: _sets(it, width), "id long, registers binary, elements binary"), "sets")
    star = member.where((F.col("id") != F.col("first.id")) & (100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n")))
    links = scratch.put(verify(star.select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct(), sets, percent), "links")
    parts = scratch.put(connected_components(links, scratch, "cc1"), "parts")
    more = scratch.put(residual_links(member.select("key", "id"), sets, parts, percent), "more")
    for name in ("members", "sets"):
        scratch.drop(name)
    if more.isEmpty():
        final = parts
    else:
        final = connected_components(links.unionByName(more), scratch, "cc2")
    joined = classes.select("hi", "lo", "id", "copies").join(final, F.col("id") == F.col("node"), "left")
    told = joined.select("hi", "lo", F.coalesce("component", "id").alias("component"), "copies", F.col("id").alias("rep")).where("copies > 1 OR component != rep").drop("copies", "rep")
    out = every.drop("registers").join(told, ["hi", "lo"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """The documents with one of each near-duplicate component; columns stay as they are."""
    gone = near_dedup(spark, docs, id_col, text_col, percent).where("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
