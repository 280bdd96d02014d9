import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import sparlode.llm.suffix_dedup as module
from sparlode.llm.suffix_array import concatenate, longest_previous_factors, previous_smaller, repeated_starts, suffix_order
from sparlode.llm.suffix_dedup import content_hashes, segments, sliding_minimum, suffix_dedup

from .conftest import by_id

LENGTH = 40


def brute(rows, length, keep_first):
    """What stays, by a table of all strings of the length."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    seen, where = set(), {}
    data = [(t or "").encode() for _, t in rows]
    for k in order:
        for s in range(len(data[k]) - length + 1):
            where.setdefault(data[k][s : s + length], []).append((k, s))
    out = {}
    for k, (i, _) in enumerate(rows):
        gone = np.zeros(len(data[k]), dtype=bool)
        for s in range(len(data[k]) - length + 1):
            places = where[data[k][s : s + length]]
            if len(places) > 1 and not (keep_first and places[0] == (k, s)):
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(data[k], dtype=np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.setdefault(i, []).append((len(data[k]), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v, key=str) for i, v in out.items()}


def sample(seed=1):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [make(n) for n in (45, 90, 300, 39)]
    rows = [(i, make(rng.randrange(60)) + rng.choice(shared) + make(rng.randrange(60)) + rng.choice(shared) + make(5)) for i in range(1, 40)]
    rows += [(100, None), (101, ""), (102, "ab" * 400), (103, "x" * 500), (104, "x" * 100), (105, shared[2] * 3), (106, make(5000)), (107, rows[3][1]), (108, rows[3][1])]
    return rows


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("crowded", [1000, 2])
def test_against_all_strings(shipped, docs, keep_first, crowded, monkeypatch):
    monkeypatch.setattr(module, "CROWDED", crowded)
    rows = sample()
    got = by_id(suffix_dedup(shipped, docs(rows), length=LENGTH, keep_first=keep_first), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute(rows, LENGTH, keep_first)


def test_empty_and_text(shipped, docs):
    assert suffix_dedup(shipped, docs([])).count() == 0
    rows = [(1, "q" * 10 + "0123456789" * 5), (2, "0123456789" * 5)]
    got = by_id(suffix_dedup(shipped, docs(rows), length=50, with_text=True), "kept", "spans")
    assert bytes(got[1][0][0]) == rows[0][1].encode() and bytes(got[2][0][0]) == b""
    assert [tuple(s) for s in got[2][0][1]] == [(0, 50)]


def test_repeated_rows(shipped, docs):
    rows = [(1, "z" * 3 + "0123456789" * 8), (1, "z" * 3 + "0123456789" * 8)]
    got = by_id(suffix_dedup(shipped, docs(rows), length=80, keep_first=False), "n_removed")
    assert got == {1: [(83,), (83,)]}


def lpf(text):
    return [max([0, *(next((k for k in range(len(text) - i + 1) if i + k >= len(text) or text[i + k] != text[j + k]), 0) for j in range(i))]) for i in range(len(text))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=4))
def test_longest_previous_factors(parts):
    symbols, _ = concatenate(parts)
    want = lpf(symbols.tolist())
    for depth in (None, 1, 2, 3, 4, 7, 11):
        factor, source = longest_previous_factors(symbols, depth)
        assert factor.tolist() == [min(k, depth or k) for k in want]
        for i, (k, j) in enumerate(zip(factor.tolist(), source.tolist())):
            assert (j == -1 and not k) or (j < i and symbols[i : i + k].tolist() == symbols[j : j + k].tolist())
    for depth in (1, 2, 5):
        factor, source = longest_previous_factors(symbols, depth, shorter=False)
        assert factor.tolist() == [depth * (k >= depth) for k in want] and ((source >= 0) == (factor > 0)).all()
    order, _ = suffix_order(symbols)
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols.tolist()[i:])
    for length in (1, 2, 5):
        later, anywhere = repeated_starts(symbols, length)
        assert [bool(x) for x in later] == [k >= length for k in want]
        strings = [tuple(symbols.tolist()[i : i + length]) for i in range(len(symbols))]
        assert [bool(x) for x in anywhere] == [len(s) == length and strings.count(s) > 1 for s in strings]


@settings(max_examples=60, deadline=None)
@given(st.permutations(range(30)))
def test_previous_smaller(values):
    want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(30)]
    assert previous_smaller(np.array(values)).tolist() == want


def test_previous_smaller_of_long_runs():
    values = np.concatenate([np.arange(1, 3000), [0]])
    assert previous_smaller(values).tolist() == [*range(-1, 2998), -1]


def test_factors_decide(shipped, docs, monkeypatch):
    """Without longest previous factors nothing but whole copies goes."""
    rows = [(i, f"{i} " * 30 + "the passage that all of them have in common" * 3 + f" {i * i}" * 30) for i in range(1, 9)]
    count = lambda: suffix_dedup(shipped, docs(rows, 1), length=LENGTH, keep_first=False).groupBy().sum("n_removed").first()[0]
    assert count() > 8 * 100
    from sparlode.llm import suffix_array

    monkeypatch.setattr(suffix_array, "longest_previous_factors", lambda symbols, depth=None, shorter=True: (np.zeros(len(symbols), dtype=np.int64), np.full(len(symbols), -1)))
    symbols, _ = concatenate([rows[0][1].encode(), rows[1][1].encode()])
    assert not suffix_array.repeated_starts(symbols, LENGTH)[1].any()


def test_thue_morse(shipped, docs):
    """Two strings that polynomial hashes modulo a power of two can't tell apart."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    assert (content_hashes(word.encode() + other.encode(), [0, 2048], [2048, 4096])[0] != content_hashes(other.encode(), [0], [2048])[0]).any()
    rows = [(1, word), (2, other), (3, "c" * 30)]
    got = by_id(suffix_dedup(shipped, docs(rows), length=LENGTH, keep_first=False), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute(rows, LENGTH, False)


def test_segments_cover_all_windows(monkeypatch):
    rng = random.Random(4)
    for data in (bytes(rng.randrange(4) for _ in range(3000)), b"a" * 3000, b"ab" * 1500, bytes(rng.randrange(256) for _ in range(41))):
        for chunk in (1 << 20, 500):
            monkeypatch.setattr(module, "CHUNK", chunk)
            _, first, last, *_ = segments(data, 40)
            covered = [s for a, b in zip(first, last) for s in range(a, b + 1)]
            assert covered == list(range(len(data) - 39))
    assert len(segments(b"short", 40)[0]) == 0


def test_sliding_minimum():
    x = np.array([5, 3, 4, 9, 1, 7, 8, 2, 6], dtype=np.uint64)
    for w in range(1, 10):
        assert sliding_minimum(x, w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]
