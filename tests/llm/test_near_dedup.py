import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sparlode.llm.setsketch import REGISTERS, drop_near_copies, joint_estimate, linked, merge, near_dedup, sketch
from sparlode.llm.shingles import shingles, word_hashes

from .conftest import LONG, by_id


def brute(rows, percent=75):
    """Components by comparing all pairs of word shingle sets."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                one, other = find(a), find(b)
                root[max(one, other)] = min(one, other)
    return {i: sorted((len(s), find(i), find(i) == i) for s in sets[i]) for i in ids}


def sample(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.choice([1, 4, 12])):
            edited = list(base)
            for _ in range(rng.randrange(0, 4)):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((n := n + 1, " ".join(edited)))
    return rows


EDGES = [(1001, None), (1002, ""), (1003, " \t\r\n"), (1004, "one"), (1005, "ONE"), (1006, "one two three"), (1007, "one two three"), (1008, LONG), (1009, LONG + "tail"), (1010, "naïve É"), (1011, "naïve é")]


def test_against_all_pairs(shipped, docs):
    rows = sample() + EDGES
    assert by_id(near_dedup(shipped, docs(rows)), "n_shingles", "component_id", "kept") == brute(rows)


def test_chain_without_common_neighbour(shipped, docs):
    """Each link of the chain holds; its ends are far apart, and no bucket's first member links to all."""
    rng = random.Random(5)
    text = [f"c{rng.random()}" for _ in range(80)]
    rows = []
    for i in range(30):
        rows.append((i + 1, " ".join(text)))
        text[(i * 5) % 80] = f"d{rng.random()}"
    assert by_id(near_dedup(shipped, docs(rows)), "n_shingles", "component_id", "kept") == brute(rows)


def test_large_group_of_copies(shipped, docs):
    rows = [(i, "same words in every one of these many copies here") for i in range(1, 400)]
    got = by_id(near_dedup(shipped, docs(rows)), "component_id")
    assert {v[0][0] for v in got.values()} == {1}
    assert [r.doc_id for r in drop_near_copies(shipped, docs(rows)).collect()] == [1]


def test_null_ids_repeats_empty(shipped, docs):
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, None)]
    got = by_id(near_dedup(shipped, docs(rows)), "n_shingles", "component_id", "kept")
    assert got == {None: [(0, None, True), (2, None, True)], 2: [(2, 2, True)] * 2}
    assert near_dedup(shipped, docs([])).count() == 0
    assert drop_near_copies(shipped, docs(rows)).columns == docs(rows).columns


def test_words_are_cut_at_ascii_blanks_only():
    assert len(word_hashes("a\x1cb c d\x0be")) == 3
    assert (word_hashes("ÀB") != word_hashes("àb")).all() and (word_hashes("AB") == word_hashes("ab")).all()


@settings(max_examples=30, deadline=None)
@given(st.integers(50, 400), st.floats(0.2, 1.0))
def test_estimate_and_merge(n, share):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    y = np.concatenate([x[: int(share * len(x))], rng.integers(0, 2**63, len(x) - int(share * len(x)), dtype=np.uint64)])
    y = np.unique(y)
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    a, b = sketch(x), sketch(y)
    assert len(a) == REGISTERS
    assert (merge(a, b) == sketch(np.union1d(x, y))).all()
    assert abs(joint_estimate(a[None], b[None], np.array([len(x)]), np.array([len(y)]))[0] - true) < 0.25
    assert linked(x, y, 75) == (100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y)))


def test_shingles_of_short_texts():
    assert len(shingles(word_hashes(""))) == 0
    assert len(shingles(word_hashes("a b"))) == 1
    assert len(shingles(word_hashes("a b c d e"))) == 1
    assert len(shingles(word_hashes("a a a a a a a"))) == 1


def test_two_texts_under_one_id(shipped, docs):
    """Each class is compared by its own set, whichever rows share its identifier."""
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long), (1, "quite another text with nine words in it"), (2, long + " more"), (3, "unrelated words that stand here all by themselves")]
    got = by_id(near_dedup(shipped, docs(rows)), "component_id")
    assert got[2] == [(1,)] and got[3] == [(3,)] and got[1] == [(1,), (1,)]
