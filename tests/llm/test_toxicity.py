import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparlode.llm import toxicity
from sparlode.llm.toxicity import Index, Vocabulary, association

from .conftest import LONG, by_id


def examples(seed, n, terms=40):
    rng = random.Random(seed)
    names = [f"term{k}" for k in range(terms)]
    vocabulary = Vocabulary({t: i for i, t in enumerate(names)}, 1.0 + np.arange(terms) / 7)
    out = []
    for i in range(n):
        counts = {t: rng.randrange(1, 4) for t in rng.sample(names, rng.randrange(0, 6))}
        out.append((i, *vocabulary.vector(counts), int(rng.random() < 0.3)))
    return vocabulary, out


@pytest.mark.parametrize("n", [0, 1, 30, 700])
def test_nearest_is_exact(n):
    """Block-max search against cosines with every entry."""
    vocabulary, rows = examples(n, n)
    index = Index(vocabulary, rows, neighbours=10)
    dense = np.zeros((len(index.count), len(vocabulary.terms)))
    for term in range(len(vocabulary.terms)):
        own = slice(index.start[index.lists[term]], index.start[index.lists[term + 1]])
        dense[index.entry[own], term] = index.weight[own]
    for _, at, weight, _ in rows[:80]:
        q = np.zeros(len(vocabulary.terms))
        q[at] = weight
        cosines = dense @ q
        order = sorted((k for k in range(len(cosines)) if cosines[k] > 0), key=lambda k: (-round(cosines[k], 9), k))
        want, met = [], 0
        for k in order:
            want.append(k)
            met += index.count[k]
            if met >= 10:
                break
        got = index.nearest(at, weight)
        assert [e for _, e in got] == want
        assert np.allclose([s for s, _ in got], cosines[want])


def test_votes_and_calibration():
    vocabulary = Vocabulary({"bad": 0, "fine": 1}, np.ones(2))
    rows = [(i, *vocabulary.vector({"bad": 1} if i % 4 == 0 else {"fine": 1} if i % 4 == 1 else {}), int(i % 4 == 0)) for i in range(400)]
    index = Index(vocabulary, rows, neighbours=15)
    index.calibrate()
    assert index.score("so bad")[0] > 0.9
    assert index.score("so fine")[0] < 0.1
    for text in (None, "", "nothing known", "123"):
        assert 0 <= index.score(text)[0] < 0.1


def test_association():
    bad, rare, fine, all_of_them = association(np.array([40, 2, 1, 50]), np.array([2, 0, 300, 500]), 50, 500)
    assert bad > fine > rare > all_of_them and abs(all_of_them - toxicity.FLOOR) < 1e-6
    assert association(np.zeros(0), np.zeros(0), 0, 0).shape == (0,)


def test_neighbours_against_raw_texts(shipped, docs):
    """The nearest examples by weighted TF-IDF cosine, worked out from the texts alone, all pairs."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices([f"word{k}" for k in range(60)], k=rng.randrange(1, 25)) + ["vile"] * (i % 3 == 0))) for i in range(150)]
    labels = shipped.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows[:90]], "doc_id long, toxic int")
    index = toxicity.fit(shipped, docs(rows), labels)
    words = [Counter(re.findall(r"[a-z]+", t)) for _, t in rows]
    held = Counter(w for c in words for w in c)

    def weight(w):
        p, n = (sum(w in words[i] for i in range(90) if (i % 3 == 0) == toxic) for toxic in (True, False))
        g, cells = 0.0, [(p, p + n, 30), (n, p + n, 60), (30 - p, 90 - p - n, 30), (60 - n, 90 - p - n, 60)]
        for seen, row, side in cells:
            g += 2 * seen * math.log(seen * 90 / (row * side)) if seen else 0.0
        return (math.log(151 / (1 + held[w])) + 1) * (0.1 + math.sqrt(max(0.0, g - 6.63)))

    known = {w: weight(w) for c in words[:90] for w in c}
    vectors = [{w: (1 + math.log(n)) * known[w] for w, n in c.items() if w in known} for c in words]
    for q in vectors:
        length = math.sqrt(sum(x * x for x in q.values())) or 1.0
        for w in q:
            q[w] /= length
    for i, text in rows[90:]:
        cosines = sorted((sum(x * vectors[k].get(w, 0.0) for w, x in vectors[i].items()) for k in range(90)), reverse=True)
        got = [s for s, e in index.score(text)[1] for _ in range(index.count[e])]
        want = [c for c in cosines[:15] if c > 1e-12]
        assert np.allclose(got[:15], want, atol=1e-9)


def test_bounds_on_the_sample(shipped, docs):
    rows = corpus()
    labels = shipped.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    some = toxicity.fit(shipped, docs([(i, t) for i, t, _ in rows]), labels, max_examples=40)
    assert some.count.sum() + some.none[0] == 40
    few = toxicity.fit(shipped, docs([(i, t) for i, t, _ in rows]), labels, max_postings=20)
    assert 0 < few.count.sum() + few.none[0] <= 20 and len(few.weight) <= 20


def corpus(rows=400):
    rng = random.Random(8)
    words = [f"neutral{k}" for k in range(50)]
    out = []
    for i in range(rows):
        toxic = i % 5 == 0
        text = " ".join(rng.choices(words, k=30) + (rng.choices(["awful", "nasty", "vile"], k=4) if toxic else []))
        out.append((i, text, int(toxic)))
    return out


def test_held_out_accuracy_and_edges(shipped, docs):
    rows = corpus()
    labels = shipped.createDataFrame([(i, y, "x") for i, _, y in rows if i % 2] + [(i, y, "x") for i, _, y in rows if i % 20 == 0] + [(None, 1, "x"), (7, None, "x"), (9, 0, "x")], "doc_id long, toxic int, text string")
    everything = docs([(i, t) for i, t, _ in rows] + [(9001, None), (9002, ""), (9003, LONG), (None, "vile nasty awful"), (9004, "awful nasty"), (9004, "awful nasty")])
    index = toxicity.fit(shipped, everything, labels)
    got = by_id(toxicity.score(shipped, everything, index), "score", "predicted")
    assert all(got[i][0][1] == y for i, _, y in rows)
    assert all(0 <= s <= 1 for v in got.values() for s, _ in v)
    assert got[9001] == got[9002] and got[9001][0][1] == 0 and len(got[9004]) == 2 and got[None][0][1] == 1
    kept = toxicity.reject_toxic(shipped, everything, index)
    assert kept.columns == everything.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, y in rows if not y} | {9001, 9002, 9003}


def test_without_labels_or_documents(shipped, docs):
    none = shipped.createDataFrame([], "doc_id long, toxic int")
    index = toxicity.fit(shipped, docs([(1, "a")]), none)
    assert [(r.score, r.predicted) for r in toxicity.score(shipped, docs([(1, "a")]), index).collect()] == [(0.5, 1)]
    assert toxicity.score(shipped, docs([]), index).count() == 0
