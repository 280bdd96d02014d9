"""Near-duplicate vectors by navigable small-world graphs, one per shard.

Equal vectors are one class first. Classes are dealt to shards by a hash; each shard's task
builds a graph of its vectors, settles the beam and finds the links among them. Then blocks of
queries of every shard go to every other shard, where a graph is read once and many blocks pass
by it; both travel in rows of bounded size, few to a batch. Two audits against brute force over the shard settle how wide a beam is: probes, made
from the shard's own vectors at exactly the threshold, so that there are always links to be
found; and a sample of the queries of each block. The beam is doubled until the recall is
reached, up to half the shard, beyond which the whole shard is looked at. A query whose whole
beam lies above the threshold may have more links than the beam holds and is held against the
whole shard on its own. Cosines are verified in double precision. A meeting returns a row per
linked query and component of the shard, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, wide
from .components import connected_components
from .hnsw import Graph

#: Beam to start with, queries per block, probes of a graph and audited queries per block, recall that audits must reach.
BEAM, BLOCK, PROBES, AUDITED, RECALL = 32, 1024, 256, 32, 0.995
#: Fewest shards, most vectors and bytes of vectors in a shard (but for chance), and blocks that share one copy of a graph, at least and where there are tasks enough.
FEWEST_SHARDS, SHARD_SIZE, SHARD_BYTES, TOGETHER, MANY_TOGETHER = 6, 50_000, 1 << 25, 16, 128
#: Bytes of a graph in a row, most bytes of a block of queries, and rows in a batch of either.
PIECE, BLOCK_BYTES, PASSING_ROWS = 1 << 18, 1 << 20, 16
#: Queries that are searched at once, places in their beams together, and cosines in a table of them.
STEP, PLACES, CELLS = 256, 1 << 19, 1 << 22


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[], [], [], []]
        for value in batch.column(1).to_pylist():
            raw = None
            if value and None not in value:
                v = np.array(value, dtype=np.float64)
                with np.errstate(over="ignore"):
                    length = math.sqrt(float(v @ v)) if np.isfinite(v).all() else 0.0
                if not 0.0 < length < math.inf and np.isfinite(v).all() and v.any():
                    v = v / np.abs(v).max()  # very small or large components: the direction is what counts
                    length = math.sqrt(float(v @ v))
                if 0.0 < length < math.inf:
                    raw = (v / length).tobytes()
            digest = hashlib.blake2b(raw or b"", digest_size=16).digest()
            for column, x in zip(rows, (raw, len(value) if raw else 0, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))):
                column.append(x)
        yield pa.record_batch([batch.column(0), pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())], names=["id", "unit", "dim", "hi", "lo"])


def _units(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def settle(graph: Graph, units: np.ndarray, queries: np.ndarray, cosine: float, beam: int, own: np.ndarray | None = None) -> tuple[int, int, int]:
    """(beam, found, true): the beam, from `beam` on, with which the queries' links are found, and how many were at last.

    own has the positions of the queries themselves, whose links to themselves don't count. A
    beam of the shard's size stands for looking at the whole shard.
    """
    n = len(units)
    truth = np.empty((len(queries), n), dtype=bool)
    for i in range(0, len(queries), rows := max(1, CELLS // n)):
        truth[i : i + rows] = (queries[i : i + rows] @ units.T) >= cosine
    if own is not None:
        truth[np.arange(len(queries)), own] = False
    true = int(truth.sum())
    while 2 * beam < n:
        found = sum(int(truth[k, at].sum()) for k, at, _ in links(graph, units, queries, cosine, beam))
        if found >= RECALL * true:
            return beam, found, true
        beam *= 2
    return n, true, true


def probes(units: np.ndarray, cosine: float) -> np.ndarray:
    """Vectors whose cosine with a vector of the shard, each with another one, is the threshold."""
    at = np.linspace(0, len(units) - 1, min(PROBES, len(units))).astype(int)
    base = units[at]
    aside = np.random.default_rng(11).normal(size=base.shape)
    aside -= (aside * base).sum(axis=1)[:, None] * base
    length = np.linalg.norm(aside, axis=1)[:, None]
    level = min(1.0, cosine + 1e-9)
    made = level * base + math.sqrt(1.0 - level * level) * aside / np.where(length > 1e-9, length, np.inf)
    return made / np.linalg.norm(made, axis=1)[:, None]


def links(graph: Graph, units: np.ndarray, queries: np.ndarray, cosine: float, beam: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(query, positions of the shard's vectors at or above the cosine in double precision, whether the whole shard was looked at)."""
    margin = cosine - 1e-4  # the search works in single precision
    step = max(1, min(STEP, CELLS // len(units) if 2 * beam >= len(units) else PLACES // beam))
    for first in range(0, len(queries), step):
        part = queries[first : first + step]
        if 2 * beam >= len(units):
            for k, row in enumerate((part @ units.T) >= cosine):
                yield first + k, np.flatnonzero(row), True
            continue
        found, near = graph.search(part, beam)
        # Queries whose beam ends above the threshold may have more links beyond it.
        open_ = near[:, -1] >= margin
        for k in np.flatnonzero(~open_):
            at = found[k][near[k] >= margin]
            yield first + k, at[units[at] @ part[k] >= cosine], False
        for k in np.flatnonzero(open_):
            yield first + k, np.flatnonzero(units @ part[k] >= cosine), True


def _build(table: pa.Table, cosine: float) -> pa.Table:
    """A row with the links within a shard and what its audits found, and rows with the pieces of its vectors and graph."""
    table = table.sort_by("id")
    dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
    units = np.frombuffer(b"".join(table["unit"].to_pylist()), dtype=np.float64).reshape(-1, dim)
    graph = Graph.build(units.astype(np.float32))
    many, ids = (np.ascontiguousarray(table[c].to_numpy()) for c in ("copies", "id"))
    del table
    beam, found, true = settle(graph, units, probes(units, cosine), cosine, min(BEAM, len(units)))
    sample = np.linspace(0, len(units) - 1, min(4 * AUDITED, len(units))).astype(int)
    beam, more, truth = settle(graph, units, units[sample], cosine, beam, sample)
    parent, linked, whole = np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64), 0

    def roots(at: np.ndarray) -> np.ndarray:
        up = parent[at]
        while (up != parent[up]).any():
            up = parent[up]
        return up

    for q, at, all_seen in links(graph, units, units, cosine, beam):
        whole += all_seen
        at = at[at != q]
        if len(at):
            linked[q] = many[at].sum()
            both = np.append(at, q)
            top = np.unique(roots(both))
            parent[top] = top[0]
            parent[both] = top[0]
    labels = ids[roots(np.arange(len(ids)))]  # in order of ids, so the smallest position has the smallest id
    data = units.tobytes() + graph.to_bytes()
    pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
    head = {"pieces": len(pieces), "cut": units.nbytes, "ids": ids.tobytes(), "copies": many.tobytes(), "labels": labels.tobytes(), "linked": linked.tobytes()}
    head |= {"beam": beam, "true": true + truth, "found": found + more, "asked": len(ids), "whole": whole}
    rows = [head, *({"data": x} for x in pieces)]
    return pa.Table.from_pylist([{"dim": dim, "shard": shard, "piece": k} | x for k, x in enumerate(rows)], schema=_GRAPHS)


_BYTES = ("data", "ids", "copies", "labels", "linked")
_COUNTS = ("cut", "beam", "true", "found", "asked", "whole")
_GRAPHS = pa.schema([*((c, pa.int32()) for c in ("dim", "shard", "piece", "pieces")), *((c, pa.binary()) for c in _BYTES), *((c, pa.int64()) for c in _COUNTS)])
GRAPHS = "dim int, shard int, piece int, pieces int, " + ", ".join(f"{c} binary" for c in _BYTES) + ", " + ", ".join(f"{c} long" for c in _COUNTS)


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes packed into blocks of queries of one dimension and shard."""
    waiting: dict[tuple[int, int], tuple[list, list]] = {}

    def pack(key: tuple[int, int]) -> pa.RecordBatch:
        ids, units = waiting.pop(key)
        return pa.record_batch(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([min(ids)], pa.int64()), pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()), pa.array([b"".join(units)], pa.binary())],
            names=["dim", "home", "block", "query_ids", "queries"],
        )

    for batch in batches:
        for i, dim, shard, unit in zip(*(batch.column(k).to_pylist() for k in ("id", "dim", "shard", "unit"))):
            ids, units = waiting.setdefault((dim, shard), ([], []))
            ids.append(i)
            units.append(unit)
            if len(ids) >= BLOCK or (len(ids) + 1) * len(unit) > BLOCK_BYTES:
                yield pack((dim, shard))
    for key in sorted(waiting):
        yield pack(key)


MET = "a long, b long, n long, true long, found long, asked long, whole long"


def _met(**columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    names = ["a", "b", "n", "true", "found", "asked", "whole"]
    return pa.record_batch([pa.array(columns.get(c, [None] * n), pa.int64()) for c in names], names=names)


def _meet(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, the graph in pieces before its blocks.

    (a, b, n): query a has n links in the shard and one of them is in the component of b; a
    further component is a row with 0. A row without a has the audit of a block.
    """
    loaded: tuple | None = None
    head: dict = {}
    pieces: list[bytes] = []
    for batch in batches:
        for row in range(batch.num_rows):
            got = {k: batch.column(k)[row] for k in batch.schema.names}
            place = (got["dim"].as_py(), got["shard"].as_py())
            if got["piece"].is_valid:
                if not got["piece"].as_py():
                    loaded, head, pieces = None, got, []  # one graph at a time
                    continue
                pieces.append(got["data"].as_py())
                if len(pieces) == head["pieces"].as_py():
                    data, pieces, cut = b"".join(pieces), [], head["cut"].as_py()
                    units = np.frombuffer(data, dtype=np.float64, count=cut // 8).reshape(-1, place[0])
                    loaded = (place, Graph.from_bytes(data[cut:], units.astype(np.float32)), units, _flat(head["copies"], np.int64), _flat(head["labels"], np.int64), head["beam"].as_py())
                continue
            if loaded is None or loaded[0] != place:
                continue  # a shard without vectors
            _, graph, units, copies, labels, beam = loaded
            asked, queries = _flat(got["query_ids"], np.int64), _flat(got["queries"], np.float64).reshape(-1, place[0])
            sample = np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int)
            beam, found, true = settle(graph, units, queries[sample], cosine, beam)
            out, whole = ([], [], []), 0
            for q, at, all_seen in links(graph, units, queries, cosine, beam):
                whole += all_seen
                if len(at):
                    for k, label in enumerate(np.unique(labels[at]).tolist()):
                        for column, x in zip(out, (int(asked[q]), label, 0 if k else int(copies[at].sum()))):
                            column.append(x)
            yield _met(a=out[0], b=out[1], n=out[2])
            yield _met(true=[true], found=[found], asked=[len(queries)], whole=[whole])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows for the links within shards."""
    for batch in batches:
        for ids, labels, linked, *counts in zip(*(batch.column(c) for c in ("ids", "labels", "linked", "true", "found", "asked", "whole"))):
            a, b, n = (_flat(x, np.int64) for x in (ids, labels, linked))
            yield _met(a=a[n > 0], b=b[n > 0], n=n[n > 0])
            yield _met(**dict(zip(("true", "found", "asked", "whole"), ([c.as_py()] for c in counts))))


def _flat(value: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=kind)


def embedding_dedup(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, report: dict | None = None) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Two vectors are linked when their cosine, in double precision, is at least `cosine`.
    n_links counts the other vectors linked directly, component_id is the smallest id
    reachable by links, kept marks the row that has it. Vectors that are null, empty, zero or
    hold a null or non-finite component link with nothing, and so do vectors of different
    lengths. Rows repeated under one id are one node with the links of all. Rows without an
    id link with nothing (null component, kept). An empty table gives an empty result; other
    columns are ignored. report, if given, is filled with the audits: true links and those
    found, queries asked of shards and those held against a whole shard.
    """
    scratch = Scratch(spark, "vectors")
    source = vectors.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{vector_col}`").cast("array<double>"))
    every = scratch.put(source.mapInArrow(_read, "id long, unit binary, dim int, hi long, lo long"), "units")
    linkable = F.col("unit").isNotNull() & F.col("id").isNotNull()
    grouped = every.where(linkable).groupBy("dim", "hi", "lo").agg(F.min(F.struct("id", "unit")).alias("r"), F.count("*").alias("copies"))
    classes = scratch.put(grouped.select("dim", "hi", "lo", "copies", "r.id", "r.unit"), "classes")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    most = max(sizes.values(), default=0)
    shards = max(FEWEST_SHARDS, math.ceil(most / SHARD_SIZE), *(math.ceil(8 * d * n / SHARD_BYTES) for d, n in sizes.items()))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("hi", "lo"), F.lit(shards)).cast("int"))
    dealt = scratch.put(dealt.select("dim", "shard", "id", "unit", "copies"), "dealt")
    homes = len(sizes) * shards
    built = dealt.repartition(max(1, homes), "dim", "shard").groupBy("dim", "shard").applyInArrow(lambda t: _build(t, cosine), GRAPHS)
    graphs = scratch.put(built, "graphs")
    # Blocks of one shard's classes, sent to all other shards.
    total = sum(sizes.values())
    each = max(1, math.ceil(total / (BLOCK * max(1, homes))))
    blocks = dealt.repartition(max(1, homes * each), "dim", "shard", F.pmod(F.xxhash64("id"), F.lit(each))).select("id", "dim", "shard", "unit").mapInArrow(_block, "dim int, home int, block long, query_ids binary, queries binary")
    # Copies of a graph, so that there are tasks enough; beyond that as few as keep tasks short.
    salts = max(1, math.ceil(total / (BLOCK * MANY_TOGETHER)), min(math.ceil(total / (BLOCK * TOGETHER)), math.ceil(wide(spark) / max(1, homes))))
    blocks = scratch.put(blocks, "blocks")
    asked = blocks.withColumn("shard", F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda x: x != F.col("home")))).withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    shown = graphs.select("dim", "shard", "piece", "pieces", "data", "copies", "labels", "cut", "beam").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    passing = shown.unionByName(asked.select("dim", "shard", "salt", "query_ids", "queries"), allowMissingColumns=True)
    passing = passing.repartition(max(1, 3 * homes * salts), "dim", "shard", "salt").sortWithinPartitions("dim", "shard", "salt", F.col("piece").isNull(), "piece")
    within = graphs.where("piece = 0").select("ids", "labels", "linked", "true", "found", "asked", "whole")
    met = scratch.put(passing.mapInArrow(lambda it: _meet(it, cosine), MET).unionByName(within.mapInArrow(_within, MET)), "met", PASSING_ROWS)
    for name in ("dealt", "graphs", "blocks"):
        scratch.drop(name)
    if report is not None:
        report.update(met.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("true", "found", "asked", "whole")]).first().asDict())
    found = connected_components(met.where("a != b").select("a", "b"), scratch)
    counts = met.where("a IS NOT NULL").groupBy("a").agg(F.sum("n").alias("linked"))
    told = (
        classes.select("dim", "hi", "lo", "copies", "id")
        .join(found, F.col("id") == F.col("node"), "left")
        .join(counts, F.col("id") == F.col("a"), "left")
        .select("dim", "hi", "lo", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component"))
        .where("n_links > 0")
    )
    out = every.drop("unit").join(told, ["dim", "hi", "lo"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
