import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import sparlode.llm.paragraph_dedup as module
from sparlode.llm.paragraph_dedup import BAND, RECALL, band_keys, bands_needed, outlines, paragraph_dedup, possible, units
from sparlode.llm.setsketch import linked
from sparlode.llm.shingles import all_shingles, mix, shingles, word_hashes

from .conftest import LONG, by_id


def brute(rows, min_words=8, percent=75):
    """Offsets that go, by comparing all pairs of paragraphs."""
    items = []
    for i, t in sorted(rows):
        for begin, _, w in units((t or "").encode(), min_words):
            items.append((i, begin, {tuple(w[k : k + 5]) for k in range(len(w) - 4)}))
    root = list(range(len(items)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in range(len(items)):
        for b in range(a):
            x, y = items[a][2], items[b][2]
            if 100 * len(x & y) >= percent * len(x | y):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    gone = {i: [] for i, _ in rows}
    for k, (i, begin, _) in enumerate(items):
        if find(k) != k:
            gone[i].append(begin)
    return {i: [(sorted(v),)] for i, v in gone.items()}


def sample():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(200)]
    shared = [[rng.choice(words) for _ in range(n)] for n in (12, 30, 60, 60)]
    rows = []
    for i in range(1, 50):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(shared)) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randrange(3, 40))]
            for _ in range(rng.randrange(3)):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, LONG), (104, LONG + "\nend")]


def test_against_all_pairs(shipped, docs):
    rows = sample()
    assert by_id(paragraph_dedup(shipped, docs(rows)), "removed") == brute(rows)


def test_text_and_empty(shipped, docs):
    line = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"head\n{line}\ntail"), (2, f"{line}\nrest"), (3, line)]
    got = by_id(paragraph_dedup(shipped, docs(rows), with_text=True), "kept", "n_removed", "n_spans")
    assert got == {1: [(rows[0][1], 0, 0)], 2: [("rest", len(line) + 1, 1)], 3: [("", len(line), 1)]}
    assert paragraph_dedup(shipped, docs([])).count() == 0


def test_repeated_rows_and_null_ids(shipped, docs):
    line = "one two three four five six seven eight nine ten eleven"
    got = by_id(paragraph_dedup(shipped, docs([(5, line), (5, line), (None, line)])), "removed")
    assert got == {None: [([],)], 5: [([0],), ([0],)]}


def test_bands():
    b = bands_needed(0.75)
    assert 1 - (1 - 0.75**BAND) ** b >= RECALL > 1 - (1 - 0.75**BAND) ** (b - 1)


def test_a_pair_at_the_threshold_is_hardly_missed():
    assert (1 - 0.75**BAND) ** bands_needed(0.75) <= 1e-4


def test_sets_together_as_one_by_one():
    split = [t.lower().encode().split() for _, t in sample() if t and len(t.split()) >= 5]
    elements, begins = all_shingles(split)
    ends = [*begins[1:], len(elements)]
    assert [elements[a:b].tolist() for a, b in zip(begins, ends)] == [shingles(word_hashes(b" ".join(w))).tolist() for w in split]
    keys = band_keys(elements, begins, 12)
    assert (keys == np.concatenate([band_keys(elements[a:b], np.zeros(1, dtype=np.int64), 12) for a, b in zip(begins, ends)])).all()
    assert (band_keys(np.tile(elements, 200)[: 1 << 16], np.zeros(1, dtype=np.int64), 12) == band_keys(elements, np.zeros(1, dtype=np.int64), 12)).all()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. !\n\t", max_size=80))
def test_units_partition_what_they_cover(text):
    data = text.encode()
    at = 0
    for begin, end, words in units(data, 3):
        assert at <= begin < end <= len(data) and words == data[begin:end].split() and len(words) >= 3
        assert b"\n" not in data[begin : end - 1]
        at = end


def test_passage_inside_lines():
    """Whatever surrounds a passage, its inner sentences are the same units."""
    passage = "First of all this begins. Then comes a sentence that has more than eight words in it. Short. Another sentence of the passage that is long enough to count, too."
    found = [{bytes(f"{a}{passage}{b}".encode()[x:y]).strip() for x, y, _ in units(f"{a}{passage}{b}".encode(), 8)} for a, b in (("", ""), ("some words before ", " and some after"), ("One. Two three.\n", "\nEnd."))]
    assert len(set.intersection(*found)) >= 2


def test_passage_goes_from_all_but_one(shipped, docs):
    rng = random.Random(9)
    passage = " ".join(" ".join(rng.choice("abcdefghij") * rng.randrange(2, 9) + str(rng.randrange(50)) for _ in range(n)).capitalize() + "." for n in (10, 14, 9, 22))
    other = lambda n: " ".join(f"u{rng.random()}" for _ in range(n))
    rows = [(i, f"{other(20)} {passage} {other(15)}") for i in range(1, 30)]
    got = by_id(paragraph_dedup(shipped, docs(rows)), "n_removed")
    assert got[1] == [(0,)] and all(got[i][0][0] > 0.5 * len(passage) for i in range(2, 30))


def test_hot_keys_are_sent_once(monkeypatch):
    """However classes are dealt, those of one key end in one bucket, and a hot key does not gather its classes in one part."""
    rng = np.random.default_rng(5)
    ids = rng.permutation(3000).astype(np.int64)
    keys = rng.integers(0, 2**64, (3000, 2), dtype=np.uint64) >> np.uint64(54) << np.uint64(54)  # 1,024 keys a column
    keys[:, 0] = np.where(ids % 2 == 0, np.uint64(77), keys[:, 0])
    monkeypatch.setattr(module, "SORTED", 500)
    batches = [pa.record_batch([pa.array([x[i : i + 50].tobytes() for i in range(0, 3000, 50)], pa.binary()) for x in (ids, keys)], names=["ids", "k0"])]
    dealt = [r for b in module._deal((batches[0].slice(i, 5) for i in range(0, 60, 5)), 7) for r in b.to_pylist()]
    parts = [[r for r in dealt if r["part"] == p] for p in range(7)]
    sent = np.concatenate([np.frombuffer(r["keys"], dtype=np.uint64) for r in dealt if r["keys"]])
    assert (sent == 77).sum() == 6 and set(range(7)) >= {r["part"] for r in dealt}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    schema = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("keys", "ids", "members"))])
    members = set()
    for p in parts:
        for b in module._meet(iter([pa.RecordBatch.from_pylist(p, schema=schema)])):
            for key, i, first in zip(*(c.to_pylist() for c in b.columns)):
                members |= {(key, i), (key, first)}
                root[find((key, i))] = find((key, first))
    want = {}
    for i, both in zip(ids.tolist(), keys.view(np.int64).tolist()):
        for key in set(both):
            want.setdefault(key, set()).add(i)
    want = {k: v for k, v in want.items() if len(v) > 1}
    assert members == {(k, i) for k, v in want.items() for i in v}
    assert all(len({find((k, i)) for i in v}) == 1 for k, v in want.items())


def test_small_blocks_are_compared_together(monkeypatch):
    """The links of many blocks are those of all pairs of a query and a target of one block, whatever the batches."""
    rng = np.random.default_rng(6)
    rows, sets = [], []
    for n in range(400):
        base = rng.integers(0, 2**63, 24, dtype=np.uint64)
        for j in range(3):
            own = np.unique(np.append(base[: 24 - 2 * j], rng.integers(0, 2**63, j, dtype=np.uint64)))
            keys = band_keys(own, np.zeros(1, dtype=np.int64), 12)
            sets.append(own)
            rows += [(n // 2, 0, n % 2, 3 * n + j, 3 * n + j, q, keys.tobytes(), own.tobytes()) for q in ([False, True] if j else [False])]
    rows.sort(key=lambda r: r[:3])
    table = pa.table(dict(zip(("main", "cut", "part", "id", "component", "query", "registers", "elements"), map(list, zip(*rows)))))
    calls = []
    compared = module._compared
    monkeypatch.setattr(module, "_compared", lambda *a: calls.append(1) or compared(*a))
    monkeypatch.setattr(module, "COMPARED", 600)
    found = {(a, b) for x in module._links_in_blocks(iter(table.to_batches(max_chunksize=77)), 75) for a, b in zip(*(c.to_pylist() for c in x.columns))}
    assert 1 < len(calls) <= 4
    alike = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))
    assert found and all(alike(a, b) for a, b in found)
    for n in range(0, 1200, 3):  # links enough to join what belongs together
        joined = sum(a // 3 == n // 3 for a, b in found)
        assert joined == 2 or joined == sum(alike(n + j, n + k) for j in range(3) for k in range(j)) < 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True), st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True))
def test_outlines_exclude_no_link(x, y):
    sets = [np.sort(mix(np.array(v, dtype=np.uint64))) for v in (x, y)]
    outline = outlines(np.concatenate(sets), np.array([0, len(x)]))
    may = possible(np.array([len(x), len(y)]), outline, np.array([0]), np.array([1]), 75)[0]
    assert may or not linked(*sets, 75)
