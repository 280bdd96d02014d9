import hashlib

import pytest

from sparlode.llm.exact_dedup import drop_copies, exact_dedup

from .conftest import LONG, by_id


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (6, "a"), (7, LONG), (8, LONG), (9, "A"), (10, "é")]


@pytest.mark.parametrize("keep, best", [("min", min), ("max", max)])
@pytest.mark.parametrize("parts", [1, 5, 40])
def test_groups(shipped, docs, keep, best, parts):
    got = by_id(exact_dedup(shipped, docs(ROWS, parts), keep=keep, fan_in=2), "keep_id", "group_size", "kept", "text_sha256")
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    assert got == {i: [(best(groups[t or ""]), len(groups[t or ""]), i == best(groups[t or ""]), sha(t))] for i, t in ROWS}


def test_null_ids_and_repeated_rows(shipped, docs):
    rows = [(None, "a"), (2, "a"), (2, "a"), (None, "z"), (None, "z"), (5, "q")]
    got = by_id(exact_dedup(shipped, docs(rows)), "keep_id", "group_size", "kept")
    assert got[2] == [(2, 3, True)] * 2
    assert got[None] == [(2, 3, False), (None, 2, True), (None, 2, True)]
    kept = sorted(((r.doc_id, r.text) for r in drop_copies(shipped, docs([*rows, (5, "q"), (5, None), (5, "")])).collect()), key=str)
    assert kept == sorted([(2, "a"), (None, "z"), (5, "q"), (5, None)], key=str) or kept == sorted([(2, "a"), (None, "z"), (5, "q"), (5, "")], key=str)


def test_empty(shipped, docs):
    assert exact_dedup(shipped, docs([])).count() == 0
    assert drop_copies(shipped, docs([])).count() == 0


def test_drop_keeps_columns(shipped, docs):
    out = drop_copies(shipped, docs(ROWS), keep="max")
    assert out.columns == docs(ROWS).columns
    assert sorted(r.doc_id for r in out.collect()) == [4, 5, 6, 8, 9, 10]


def test_arguments(shipped, docs):
    with pytest.raises(ValueError):
        exact_dedup(shipped, docs(ROWS), keep="first")
    with pytest.raises(ValueError):
        exact_dedup(shipped, docs(ROWS), fan_in=1)


def test_no_python_on_executors(shipped, docs):
    plan = exact_dedup(shipped, docs(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
