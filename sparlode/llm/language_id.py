"""Language identification of spans in mixed-language text.

Scripts narrow the candidates: a word's script, by Unicode ranges, allows only the languages
whose training text uses that script. Within these, a character trigram model per language
gives every word a score, and Viterbi decoding over the words with a penalty for switching
labels spans. A run of letters is cut where its script changes and after LONGEST letters, so long
text without blanks is judged as a whole and may change its language. A document's language is the one that labels most of its letters.

The model is fitted on a bounded, documented sample of labelled documents and is broadcast.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: First code point, last code point and name of the script ranges told apart; letters elsewhere are "other".
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"), (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"), (0x0B80, 0x0BFF, "tamil"), (0x0E00, 0x0E7F, "thai"),
    (0x10A0, 0x10FF, "georgian"), (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"), (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
]
OTHER = "other"
UNKNOWN = "und"
#: Log-odds a change of language must gain; words whose scores a worker remembers.
PENALTY, CACHED = 6.0, 300_000
#: Pseudo-count per character in the trigram model and share of a language's letters that makes a script its own.
SMOOTHING, OWN_SCRIPT = 0.05, 0.002
#: Letters of a piece of a run of letters.
LONGEST = 256


def script_of(letter: str) -> str:
    c = ord(letter)
    for first, last, name in SCRIPTS:
        if c <= last:
            return name if c >= first else OTHER
    return OTHER


def _piece_pattern() -> regex.Pattern:
    """Pieces of one script; marks belong to the letter before them."""
    ranges: dict[str, str] = {}
    for first, last, name in SCRIPTS:
        ranges[name] = ranges.get(name, "") + f"\\U{first:08x}-\\U{last:08x}"
    letters = [*(rf"[[{r}]&&\p{{L}}]" for r in ranges.values()), rf"[\p{{L}}--[{''.join(ranges.values())}]]"]
    return regex.compile("|".join(rf"(?:{x}\p{{M}}*+){{1,{LONGEST}}}+" for x in letters), regex.V1)


PIECE = _piece_pattern()


@functools.lru_cache(CACHED)
def _parts(word: str) -> tuple[str, ...]:
    return tuple(PIECE.findall(word))


def pieces(text: str) -> list[str]:
    """The words of a text, runs of several scripts or of more than LONGEST letters in consecutive pieces."""
    found = WORD.findall(text)
    if text.isascii() and max(map(len, found), default=0) <= LONGEST:
        return found
    out: list[str] = []
    for w in found:
        if len(w) > 48:
            out += PIECE.findall(w)
        elif w.isascii():
            out.append(w)
        else:
            out += _parts(w)
    return out


class Model:
    """Scores of words by language, from trigram counts {(language, trigram): count} and letters by script."""

    def __init__(self, trigrams: dict[tuple[str, str], int], scripts: dict[tuple[str, str], int], penalty: float = PENALTY):
        self.languages = sorted({lang for lang, _ in trigrams} | {lang for lang, _ in scripts})
        self.penalty, size = penalty, len(self.languages)
        number = {lang: i for i, lang in enumerate(self.languages)}
        letters: Counter = Counter()
        for (lang, _), n in scripts.items():
            letters[lang] += n
        self.allowed: dict[str, np.ndarray] = {}
        for (lang, script), n in scripts.items():
            if n >= OWN_SCRIPT * letters[lang]:
                self.allowed.setdefault(script, np.zeros(size, dtype=bool))[number[lang]] = True
        alphabet = max(1, len({g[2] for _, g in trigrams}))
        heads: dict[str, np.ndarray] = {}
        counts: dict[str, np.ndarray] = {}
        for (lang, g), n in trigrams.items():
            counts.setdefault(g, np.zeros(size))[number[lang]] += n
            heads.setdefault(g[:2], np.zeros(size))[number[lang]] += n
        self.heads = {h: np.log(SMOOTHING / (c + SMOOTHING * alphabet)) for h, c in heads.items()}
        self.scores = {g: np.log((c + SMOOTHING) / (heads[g[:2]] + SMOOTHING * alphabet)) for g, c in counts.items()}
        self.unseen = np.full(size, -math.log(alphabet))
        self.known: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def word(self, word: str) -> np.ndarray:
        """Log-likelihood of a lower-case word in each language, less the best one's; languages of another script are far behind."""
        marked = f"\x02\x02{word}\x03"
        total = np.zeros(len(self.languages))
        for i in range(len(word) + 1):
            g = marked[i : i + 3]
            s = self.scores.get(g)
            total += s if s is not None else self.heads.get(g[:2], self.unseen)
        allowed = self.allowed.get(script_of(word[0]))
        if allowed is not None:
            total = np.where(allowed, total, total - 30.0)
        return total - total.max()

    def _numbered(self, texts: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray]:
        if len(self.known) > CACHED:
            self.known.clear()
        place = {w: i for i, w in enumerate(set().union(*texts))}
        table = np.zeros((max(1, len(place)), len(self.languages)))
        for w, i in place.items():
            got = self.known.get(w)
            if got is None:
                got = self.word(w)
                if len(w) <= 48:
                    self.known[w] = got
            table[i] = got
        return [np.fromiter(map(place.__getitem__, t), dtype=np.int32, count=len(t)) for t in texts], table

    def paths(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The best sequence of languages (numbers) of each text's lower-case words.

        Texts go side by side, longest first, so that the steps over words are shared.
        """
        words, table = self._numbered(texts)
        out: list[np.ndarray] = [np.zeros(0, dtype=np.int8)] * len(texts)
        order = sorted((i for i in range(len(texts)) if len(words[i])), key=lambda i: -len(words[i]))
        start = 0
        while start < len(order):
            longest = len(words[order[start]])
            stop = start
            while stop < len(order) and stop - start < 256 and 3 * len(words[order[stop]]) >= longest and (stop - start + 1) * longest <= 400_000:
                stop += 1
            stop = max(stop, start + 1)
            part = order[start:stop]
            lengths = np.array([len(words[i]) for i in part])
            grid = np.zeros((longest, len(part)), dtype=np.int32)
            for k, i in enumerate(part):
                grid[: lengths[k], k] = words[i]
            active = np.searchsorted(-lengths, -np.arange(longest), side="left")
            best = table[grid[0]].copy()
            stay = np.ones((longest, len(part), len(self.languages)), dtype=bool)
            origin = np.zeros((longest, len(part)), dtype=np.int8)
            for t in range(1, longest):
                a = active[t]
                now = best[:a]
                top = now.argmax(axis=1)
                change = now[np.arange(a), top][:, None] - self.penalty
                kept = now >= change
                stay[t, :a], origin[t, :a] = kept, top
                best[:a] = np.where(kept, now, change) + table[grid[t, :a]]
            here = best.argmax(axis=1)
            path = np.zeros((longest, len(part)), dtype=np.int8)
            for t in range(longest - 1, -1, -1):
                a = active[t]
                path[t, :a] = here[:a]
                if t:
                    kept = stay[t, np.arange(a), here[:a]]
                    here[:a] = np.where(kept, here[:a], origin[t, :a])
            for k, i in enumerate(part):
                out[i] = path[: lengths[k], k].copy()
            start = stop
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share of the letters that it labels) of each text; ties go to the earlier name."""
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        words = [pieces((t or "").lower()) for t in texts]
        out = []
        for found, path in zip(words, self.paths(words)):
            if not len(path):
                out.append((UNKNOWN, 0.0))
                continue
            size = np.fromiter(map(len, found), dtype=np.float64, count=len(found))
            share = np.bincount(path, weights=size, minlength=len(self.languages)) / size.sum()
            out.append((self.languages[int(share.argmax())], float(share.max())))
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) of the maximal runs of words with one language, as character offsets."""
        found = [(m.start() + p.start(), m.start() + p.end(), p[0].lower()) for m in WORD.finditer(text or "") for p in PIECE.finditer(m[0])]
        out: list[tuple[int, int, str]] = []
        if not self.languages or not found:
            return out
        for (start, end, _), label in zip(found, self.paths([[w for *_, w in found]])[0].tolist()):
            if out and out[-1][2] == self.languages[label]:
                out[-1] = (out[-1][0], end, out[-1][2])
            else:
                out.append((start, end, self.languages[label]))
        return out


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: Counter = Counter()
    scripts: Counter = Counter()
    for batch in batches:
        words: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words.update((lang, w) for w in pieces((text.as_py() or "").lower()))
        for (lang, w), n in words.items():
            scripts[lang, script_of(w[0])] += n * len(w)
            marked = f"\x02\x02{w}\x03"
            for i in range(len(w) + 1):
                grams[lang, marked[i : i + 3]] += n
    rows = [(lang, "gram", g, n) for (lang, g), n in grams.items()] + [(lang, "script", s, n) for (lang, s), n in scripts.items()]
    columns = list(zip(*rows)) or [(), (), (), ()]
    yield pa.record_batch([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], names=["lang", "kind", "item", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_documents: int = 6000, penalty: float = PENALTY) -> Model:
    """A model of the trigrams and scripts of about max_documents labelled documents, which bound its size.

    The sample is the identifiers with the smallest hashes, a share of the labelled rows that
    makes max_documents of them. Rows with a null text, language or identifier are left out.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL AND lang IS NOT NULL")
    share = min(1.0, max_documents / max(1, rows.select("id", "lang").count()))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0)).where("text IS NOT NULL")
    counted = chosen.select("lang", "text").mapInArrow(_gram_rows, "lang string, kind string, item string, n long").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))
    found: dict[str, dict[tuple[str, str], int]] = {"gram": {}, "script": {}}
    for lang, kind, item, n in zip(*(c.to_pylist() for c in counted.toArrow().columns)):
        found[kind][lang, item] = n
    return Model(found["gram"], found["script"], penalty)


def _predicted(batches: Iterator[pa.RecordBatch], shipped, with_spans: bool) -> Iterator[pa.RecordBatch]:
    model = shipped.value
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            texts = part.column(1).to_pylist()
            got = model.predict(texts)
            columns = [part.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            names = ["doc_id", "lang_pred", "score"]
            if with_spans:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                columns.append(pa.array([[{"start": a, "end": b, "lang": c} for a, b, c in model.spans(t)] for t in texts], kind))
                names.append("spans")
            yield pa.record_batch(columns, names=names)


def identify(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """One row per document: doc_id, lang_pred, score.

    score is the share of the text's letters that lang_pred labels. Null texts and texts
    without a letter are `und` with score 0, and so is everything without training rows.
    with_spans adds the labelled spans (start, end, lang; character offsets). Rows repeated
    under one id are judged each; an empty table gives an empty result; other columns are
    ignored.
    """
    shipped = spark.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<start: long, end: long, lang: string>>" * with_spans
    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    return source.mapInArrow(lambda it: _predicted(it, shipped, with_spans), schema)
