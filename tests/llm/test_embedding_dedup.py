import math

import numpy as np
import pyarrow as pa
import pytest

import sparlode.llm.embedding_dedup as module
from sparlode.llm.embedding_dedup import embedding_dedup, links, probes, settle
from sparlode.llm.hnsw import Graph


def brute(rows, cosine=0.95):
    units = {}
    for i, v in rows:
        if v and None not in v and all(math.isfinite(x) for x in v) and any(v):
            a = np.array(v, dtype=np.float64)
            a /= np.abs(a).max()
            units.setdefault(i, []).append(a / math.sqrt(a @ a))
    root = {i: i for i, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    flat = [(i, u) for i, us in units.items() for u in us]
    n = {i: 0 for i, _ in rows}
    for k, (i, u) in enumerate(flat):
        for m, (j, w) in enumerate(flat):
            if k != m and len(u) == len(w) and u @ w >= cosine:
                n[i] += 1
                one, other = find(i), find(j)
                root[max(one, other)] = min(one, other)
    return {i: (n[i], find(i), find(i) == i) for i in n}


def sample():
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for size in (1,) * 150 + (2, 2, 5, 40, 90):
        centre = rng.normal(size=16)
        for _ in range(size):
            rows.append(((n := n + 1), [float(x) for x in centre + rng.normal(size=16) * 0.05]))
    rows += [(n + 1 + k, rows[3][1]) for k in range(30)]
    return rows + [(5001, None), (5002, []), (5003, [0.0] * 16), (5004, [1.0, None] + [0.0] * 14), (5005, [math.nan] + [1.0] * 15), (5006, [math.inf] + [1.0] * 15), (5007, [1e-30] * 16), (5008, [1e30] * 16), (5009, [1.0, 2.0])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, id string")


def test_against_all_pairs(shipped, monkeypatch):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in sample()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(shipped, frame(shipped, rows)).collect()}
    assert got == brute(rows)


def test_many_blocks_and_copies_of_graphs(shipped, monkeypatch):
    monkeypatch.setattr(module, "TOGETHER", 1)
    monkeypatch.setattr(module, "BLOCK", 32)
    rows = [(i, v) for i, v in sample() if i < 200]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(shipped, frame(shipped, rows)).collect()}
    assert got == brute(rows)


def test_through_the_graphs(shipped):
    """5,400 vectors, few of them linked: audits have links to judge by, hardly a query sees a whole shard, all links are found."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(5000, 32))
    near = [(10, 400), (20, 900), (4000, 4500)] + [(k, k + 2500) for k in range(100, 190)]
    for a, b in near:
        v[b] = v[a] + rng.normal(size=32) * 0.1
    group = v[7] + rng.normal(size=(400, 32)) * 0.05
    rows = [(i, [float(x) for x in u]) for i, u in enumerate(np.concatenate([v, group]).astype(np.float32))]
    report = {}
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(shipped, frame(shipped, rows), report=report).collect()}
    u = np.array([x for _, x in rows], dtype=np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    truth = (u @ u.T) >= 0.95
    np.fill_diagonal(truth, False)
    assert report["true"] >= 6 * 256 and report["found"] >= 0.995 * report["true"]
    assert 0 < report["whole"] < 0.2 * report["asked"]
    assert sum(n for n, _ in got.values()) >= 0.995 * truth.sum()
    assert all(got[i][0] <= truth[i].sum() for i in got)
    assert sum(got[a][1] == got[b][1] for a, b in near) >= len(near) - 1
    assert {got[i][1] for i in range(5000, 5400)} == {7}


def test_empty_and_null_ids(shipped):
    assert embedding_dedup(shipped, frame(shipped, [])).count() == 0
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup(shipped, frame(shipped, [(None, [1.0, 0.0]), (1, [1.0, 0.0])])).collect()]
    assert sorted(got, key=str) == [(1, 0, 1, True), (None, 0, None, True)]


@pytest.mark.parametrize("n", [1, 3, 65, 3000])
def test_recall_against_brute_force(n):
    rng = np.random.default_rng(n)
    v = rng.normal(size=(n, 24))
    v[n // 2 :] = v[: n - n // 2] + rng.normal(size=(n - n // 2, 24)) * 0.05
    v /= np.linalg.norm(v, axis=1)[:, None]
    graph = Graph.from_bytes(Graph.build(v.astype(np.float32)).to_bytes(), v.astype(np.float32))
    beam, seen, true = settle(graph, v, probes(v, 0.95), 0.95, min(32, n))
    assert true >= min(n, 256) and seen >= 0.995 * true and (n < 3000 or beam < n)
    found = [None] * n
    for k, at, _ in links(graph, v, v, 0.95, beam):
        found[k] = at
    truth = (v @ v.T) >= 0.95
    hits = sum(int(truth[i, f].sum()) for i, f in enumerate(found))
    assert hits >= 0.995 * truth.sum()
    assert sum(len(f) for f in found) == hits


def test_graphs_and_blocks_travel_in_small_rows(shipped, monkeypatch):
    """Neither the size of a shard nor the length of vectors makes a row large, and batches hold few rows."""
    rng = np.random.default_rng(8)
    units = rng.normal(size=(700, 48))
    units[350:] = units[:350] + rng.normal(size=(350, 48)) * 0.02
    units /= np.linalg.norm(units, axis=1)[:, None]
    monkeypatch.setattr(module, "PIECE", 4096)
    monkeypatch.setattr(module, "BLOCK_BYTES", 48 * 8 * 20)
    ids = list(range(0, 1400, 2))
    table = pa.table({"dim": pa.array([48] * 700, pa.int32()), "shard": pa.array([1] * 700, pa.int32()), "id": ids, "unit": [u.tobytes() for u in units], "copies": [1] * 700})
    built = module._build(table, 0.95)
    assert built.num_rows > 60 and max(len(x or b"") for x in built["data"].to_pylist()) == 4096
    asked = table.set_column(1, "shard", pa.array([0] * 700, pa.int32())).select(["id", "dim", "shard", "unit"])
    blocks = [r for b in module._block(iter(asked.to_batches())) for r in b.to_pylist()]
    assert max(len(r["queries"]) for r in blocks) == module.BLOCK_BYTES and len(blocks) == 35
    names = ["dim", "shard", "piece", "pieces", "data", "copies", "labels", "cut", "beam"]
    schema = pa.schema([*(module._GRAPHS.field(c) for c in names), ("query_ids", pa.binary()), ("queries", pa.binary())])
    rows = [*built.select(names).to_pylist(), *({"dim": 48, "shard": 1} | {c: r[c] for c in ("query_ids", "queries")} for r in blocks)]
    batches = pa.Table.from_pylist(rows, schema=schema).to_batches(max_chunksize=module.PASSING_ROWS)
    met = [r for b in module._meet(iter(batches), 0.95) for r in b.to_pylist()]
    got = {i: sum(r["n"] for r in met if r["a"] == i) for i in ids}
    truth = (units @ units.T) >= 0.95
    assert got == dict(zip(ids, truth.sum(axis=1).tolist()))


def test_long_vectors_make_more_shards(shipped, monkeypatch):
    monkeypatch.setattr(module, "SHARD_BYTES", 16 * 8 * 20)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in sample() if i < 200]
    report = {}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup(shipped, frame(shipped, rows), report=report).collect()}
    assert got == brute(rows)
    classes = len({tuple(v) for _, v in rows})
    assert report["asked"] == classes * math.ceil(classes / 20)
