import itertools
import random

import numpy as np

from sparlode.llm import language_id
from sparlode.llm.language_id import Model, script_of

from .conftest import LONG, by_id

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and then goes home with the others", "de": "der schnelle braune fuchs springt über den faulen hund und geht dann nach hause", "ru": "быстрая коричневая лиса прыгает через ленивую собаку и потом идёт домой"}


def training():
    rng = random.Random(1)
    return [(i, " ".join(rng.choices(TEXTS[lang].split(), k=20)), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(TEXTS), 90))]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 5) for i, t, lang in rows], "doc_id long, text string, lang string, score string, id int").repartition(3)


def model(spark, penalty=6.0):
    return language_id.fit(frame(spark, training()), penalty=penalty)


def test_documents(shipped):
    m = model(shipped)
    rows = [(i, t, None) for i, t in enumerate(TEXTS.values())] + [(10, None, None), (11, "", None), (12, "123 !?", None), (13, LONG, None), (14, "THE LAZY DOG AND THE FOX", None), (14, "der faule hund", None), (None, TEXTS["ru"], None)]
    got = by_id(language_id.identify(shipped, frame(shipped, rows), m), "lang_pred", "score")
    assert [got[i][0][0] for i in range(3)] == ["en", "de", "ru"]
    assert got[10] == got[11] == got[12] == [("und", 0.0)]
    assert [x[0] for x in got[14]] == ["de", "en"] and got[None][0][0] == "ru" and 0 <= got[13][0][1] <= 1
    assert language_id.identify(shipped, frame(shipped, []), m).count() == 0


def test_spans_of_mixed_text(shipped):
    m = model(shipped)
    text = "the quick brown fox jumps over the lazy dog. Der schnelle braune Fuchs springt über den faulen Hund! Быстрая лиса."
    spans = m.spans(text)
    assert [s[2] for s in spans] == ["en", "de", "ru"]
    assert text[spans[1][0] : spans[1][1]].startswith("Der") and text[spans[2][0] : spans[2][1]] == "Быстрая лиса"
    assert m.spans(None) == [] and m.spans("...") == []


def test_viterbi_is_optimal(shipped):
    """Paths of many texts at once against all label sequences of each."""
    m = model(shipped, penalty=2.0)
    rng = random.Random(6)
    pool = [w for t in TEXTS.values() for w in t.split()]
    texts = [[rng.choice(pool) for _ in range(rng.randrange(1, 7))] for _ in range(40)] + [[]]
    for words, path in zip(texts, m.paths(texts)):
        value = lambda p: sum(m.word(w)[l] for w, l in zip(words, p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=len(words))), default=0.0)
        assert len(path) == len(words) and np.isclose(value(path.tolist()), best)


def test_without_training_rows(shipped):
    m = language_id.fit(frame(shipped, [(1, "a b", None), (2, None, "en")]))
    assert m.predict(["some text", None])[0][0] in ("und", "en")
    assert Model({}, {}).predict(["x"]) == [("und", 0.0)]


def test_scripts():
    assert [script_of(c) for c in "aéжα中한あ"] == ["latin", "latin", "cyrillic", "greek", "han", "hangul", "kana"]
    assert script_of("ꯀ") in ("other", "hangul")


def test_runs_longer_than_a_piece_are_judged_whole(shipped):
    m = model(shipped)
    en, de, ru = ((TEXTS[k].replace(" ", "") * 40)[:n] for k, n in (("en", 300), ("de", 900), ("ru", 900)))
    (lang, score), (mixed, share) = m.predict([en + de, en + ru])
    assert lang == "de" and 0.7 < score < 0.8
    assert mixed == "ru" and share == 0.75
    assert [x[2] for x in m.spans(en + ru)] == ["en", "ru"] and m.spans(en + ru)[0][:2] == (0, 300)


def test_pieces_cover_the_letters():
    for text in ("añb語ひらがなабв" * 60, "ก็" * 300, "a\u0301" * 300, "ab cd1ef", "", "ɐbɐ x" * 9):
        assert "".join(language_id.pieces(text)) == "".join(language_id.WORD.findall(text))
    assert language_id.pieces("short words") == ["short", "words"] and language_id.pieces("абвabc") == ["абв", "abc"]
