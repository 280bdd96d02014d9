"""Removal of repeated paragraphs by MinHash banding.

The units that repeat in real texts are seldom whole lines: a passage may stand inside a longer
one. A paragraph here is a sentence of at least `min_words` words, or the short sentences between
two such sentences of a line if together they have as many words. Where a passage lies in a line
changes at most its first and last unit. Equal words are one
class; classes that share a band of MinHash values are compared on their full sets, first
with the smallest class of their bucket, then, where a bucket still holds several components,
in blocks. Components of links are clusters, and all paragraphs of a cluster but the first
(in order of document id and place) are removed. The number of bands follows from the recall
that a pair at the threshold must have; pairs above it are found more surely.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import Scratch, wide
from .components import connected_components
from .setsketch import band_pairs, linked, residual_links
from .shingles import all_shingles, mix, runs
from .suffix_dedup import remove

#: Values in a band, and the chance with which a pair at the threshold must share one.
BAND, RECALL = 2, 0.9999
#: Bands that are shuffled at once.
AT_ONCE = 4
#: Classes in a row of keys, classes whose keys are sorted at once, pairs of key and class in a partition, members in a row, and rows of blocks compared at once.
PACKED, SORTED, HELD, SENT, COMPARED = 64, 1 << 17, 1 << 21, 1 << 12, 4096
#: Bits of a set's outline.
OUTLINE = 256
_rng = np.random.default_rng(20240302)
_A = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, 256, dtype=np.uint64)


def bands_needed(similarity: float, recall: float = RECALL, band: int = BAND) -> int:
    """Bands of `band` values with which pairs at the similarity share one with the chance `recall`."""
    return math.ceil(math.log(1.0 - recall) / math.log(1.0 - similarity**band))


def band_keys(elements: np.ndarray, begins: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band (columns) of the MinHash values of each set (rows); the sets lie one after the other."""
    n = bands * BAND
    low = np.empty((len(begins), n), dtype=np.uint64)
    if len(elements) <= 1 << 15:
        np.minimum.reduceat(elements[:, None] * _A[None, :n] + _B[None, :n], begins, axis=0, out=low)
    else:
        for k in range(n):
            low[:, k] = np.minimum.reduceat(elements * _A[k] + _B[k], begins)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(begins), bands))
    for j in range(BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, j::BAND])
    return key.view(np.int64)


#: What ends a piece: the mark and blanks after a sentence, with a newline behind them, or a newline.
END = re.compile(rb"[.!?\n](?:(?<=\n)|[ \t]+\n?)")


def units(data: bytes, min_words: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(begin, end, lower-case words) of the paragraphs; a newline belongs to the last of its line."""
    at = 0
    begin, words = 0, []  # the short sentences waiting
    low = data.lower()
    ends = [m.end() for m in END.finditer(low)]
    if low and (not ends or ends[-1] < len(low)):
        ends.append(len(low))
    for end in ends:
        found = low[at:end].split()
        if len(found) >= min_words:
            if len(words) >= min_words:
                yield begin, at, words
            yield at, end, found
            begin, words = end, []
        else:
            words += found
            if low[end - 1] == 10:
                if len(words) >= min_words:
                    yield begin, end, words
                begin, words = end, []
        at = end
    if len(words) >= min_words:
        yield begin, at, words


def _paragraph_rows(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    names = ["row", "id", "place", "past", "hi", "lo"]
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            rows: list[list] = [[] for _ in names[:-2]]
            digests = []
            for row, doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                for place, past, words in units((text.as_py() or "").encode(), min_words):
                    digests.append(xxh3_128_digest(b" ".join(words)))
                    for column, value in zip(rows, (row, doc_id, place, past)):
                        column.append(value)
            hi_lo = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in rows), pa.array(hi_lo[:, 0]), pa.array(hi_lo[:, 1])], names=names)


def _listed(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """The classes and words of the listed paragraphs, some texts at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            classes, texts = [], []
            for text, listed in zip(part.column(0), part.column(1)):
                wanted = {x["place"]: x["cls"] for x in listed.as_py()}
                for begin, _, words in units((text.as_py() or "").encode(), min_words):
                    if begin in wanted:
                        classes.append(wanted[begin])
                        texts.append(words)
            if classes:
                yield classes, texts


def _class_keys(batches: Iterator[pa.RecordBatch], min_words: int, width: int, bands: int) -> Iterator[pa.RecordBatch]:
    """The band keys of the listed paragraphs of each text: PACKED classes to a row, a column for the bands of a round."""
    names = ["ids", *(f"k{k}" for k in range(0, bands, AT_ONCE))]
    for classes, texts in _listed(batches, min_words):
        ids, flat = np.array(classes, dtype=np.int64), band_keys(*runs(texts, width), bands)  # a minimum needs no distinct shingles
        columns = [ids, *(flat[:, k : k + AT_ONCE] for k in range(0, bands, AT_ONCE))]
        yield pa.record_batch([pa.array([c[i : i + PACKED].tobytes() for i in range(0, len(ids), PACKED)], pa.binary()) for c in columns], names=names)


def shared_keys(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest id of each, and a row (key, id, smallest id) for each id whose key others have, too."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    if not len(begins):
        return keys, ids, np.empty((0, 3), dtype=np.int64)
    firsts, many = np.minimum.reduceat(ids, begins), np.diff(np.append(begins, len(keys)))
    both = np.repeat(many > 1, many)
    return keys[begins], firsts, np.stack([keys[both].view(np.int64), ids[both], np.repeat(firsts, many)[both]], axis=1)


def _deal(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Keys with their classes, dealt to parts by ranges of keys.

    Classes that meet here are members of their bucket already, and only the first of them is
    sent on with the key: a key that very many classes have reaches its part once for SORTED classes.
    """
    edges = np.array([(i << 64) // parts for i in range(parts)], dtype=np.uint64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def send() -> Iterator[pa.RecordBatch]:
        ids, keys = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        keys, firsts, met = shared_keys(keys, np.repeat(ids, len(keys) // len(ids)))
        at = np.append(np.searchsorted(keys, edges), len(keys))
        full = np.flatnonzero(np.diff(at))
        blocks = [[x[at[i] : at[i + 1]].tobytes() for i in full] for x in (keys, firsts)]
        members = [met[i : i + SENT].tobytes() for i in range(0, len(met), SENT)]
        places = [*full.tolist(), *((int(keys[0] % np.uint64(parts)) + i) % parts for i in range(len(members)))]
        none: list = [None] * len(members)
        columns = [pa.array(places, pa.int32()), *(pa.array(x + none, pa.binary()) for x in blocks), pa.array([None] * len(full) + members, pa.binary())]
        yield pa.record_batch(columns, names=["part", "keys", "ids", "members"])

    size = 0
    for batch in batches:
        if batch.num_rows:
            ids, keys = (np.frombuffer(b"".join(c.to_pylist()), dtype=kind) for c, kind in zip(batch.columns, (np.int64, np.uint64)))
            waiting.append((ids, keys))
            size += len(ids)
            if size >= SORTED:
                size = 0
                yield from send()
    if waiting:
        yield from send()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of the buckets of a part: (key, id, first)."""
    waiting = [[np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]]

    def rows(met: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c) for c in np.ascontiguousarray(met.T)], names=["key", "id", "first"])

    for batch in batches:
        for keys, ids, members in zip(*(batch.column(c).to_pylist() for c in ("keys", "ids", "members"))):
            if members is not None:
                yield rows(np.frombuffer(members, dtype=np.int64).reshape(-1, 3))
            else:
                waiting[0].append(np.frombuffer(keys, dtype=np.uint64))
                waiting[1].append(np.frombuffer(ids, dtype=np.int64))
    met = shared_keys(*map(np.concatenate, waiting))[2]
    for i in range(0, len(met), 1 << 16):
        yield rows(met[i : i + (1 << 16)])


def _wanted_sets(batches: Iterator[pa.RecordBatch], min_words: int, width: int, bands: int) -> Iterator[pa.RecordBatch]:
    for classes, texts in _listed(batches, min_words):
        elements, begins = all_shingles(texts, width)
        sets = [x.tobytes() for x in np.split(elements, begins[1:])]
        keys = [x.tobytes() for x in band_keys(elements, begins, bands)]
        yield pa.record_batch([pa.array(classes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["id", "registers", "elements"])


def _star_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(batch.column(2), batch.column(3))
        mask = pa.array([linked(*(np.frombuffer(e.as_buffer(), dtype=np.uint64) for e in pair), percent) for pair in both], pa.bool_())
        yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def outlines(elements: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A bit for each hash value that a set has; the sets, none of them empty, lie one after the other."""
    bit = (mix(elements) % np.uint64(OUTLINE)).astype(np.int64)
    out = np.empty((len(begins), OUTLINE // 64), dtype=np.uint64)
    for k in range(OUTLINE // 64):
        out[:, k] = np.bitwise_or.reduceat(np.where(bit >> 6 == k, np.uint64(1) << (bit & 63).astype(np.uint64), np.uint64(0)), begins)
    return out


def possible(size: np.ndarray, outline: np.ndarray, of: np.ndarray, with_: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sets may reach the similarity: a bit that only one set has is an element that only it has."""
    x, y = outline[of], outline[with_]
    alone_x, alone_y = (np.bitwise_count(a & ~b).sum(axis=1).astype(np.int64) for a, b in ((x, y), (y, x)))
    both = np.minimum(size[of] - alone_x, size[with_] - alone_y)
    return 100 * both >= percent * (size[of] + size[with_] - both)


def _links_in_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links within blocks, whose rows come one block after the other; most blocks are small and many are compared at once."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        blocks = np.stack([batch.column(c).to_numpy() for c in ("main", "cut", "part")])
        ends = np.flatnonzero((blocks[:, 1:] != blocks[:, :-1]).any(axis=0)) + 1
        if waiting and size >= COMPARED and batch.num_rows and [waiting[-1].column(c)[-1].as_py() for c in ("main", "cut", "part")] != blocks[:, 0].tolist():
            yield _compared(waiting, percent)
            waiting, size = [], 0
        begin = 0
        for end in ends.tolist():
            if size + end - begin >= COMPARED:
                yield _compared([*waiting, batch.slice(begin, end - begin)], percent)
                waiting, size, begin = [], 0, end
        waiting.append(batch.slice(begin))
        size += batch.num_rows - begin
    if size:
        yield _compared(waiting, percent)


def _compared(batches: list[pa.RecordBatch], percent: int) -> pa.RecordBatch:
    """Links between classes that share a block and a band and not a component; most shared bands first."""
    table = pa.Table.from_batches(batches)
    ids, comp, query, main, cut, part = (table[c].to_numpy() for c in ("id", "component", "query", "main", "cut", "part"))
    block = np.cumsum(np.append(False, (main[1:] != main[:-1]) | (cut[1:] != cut[:-1]) | (part[1:] != part[:-1]))).astype(np.uint64)
    keys = np.frombuffer(b"".join(table["registers"].to_pylist()), dtype=np.int64).reshape(len(ids), -1)
    # Blocks are told apart by their keys; should two be equal for once, sets are compared in vain.
    keys = keys ^ mix(block * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)[:, None]
    raw = table["elements"].to_pylist()
    size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 8
    elements, begins = np.frombuffer(b"".join(raw), dtype=np.uint64), np.cumsum(size) - size
    root = {c: c for c in np.unique(comp).tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    found: tuple[list, list] = ([], [])
    of, with_, shared = band_pairs(keys, np.flatnonzero(query), np.flatnonzero(~query))
    fit = comp[of] != comp[with_]
    of, with_, shared = of[fit], with_[fit], shared[fit]
    outline, kept = outlines(elements, begins), [np.zeros(0, dtype=bool)]
    for i in range(0, len(of), 1 << 16):
        kept.append(possible(size, outline, of[i : i + (1 << 16)], with_[i : i + (1 << 16)], percent))
    fit = np.concatenate(kept)
    of, with_, shared = of[fit], with_[fit], shared[fit]
    for k in np.lexsort((with_, -shared, of)).tolist():
        q, t = int(of[k]), int(with_[k])
        one, other = find(int(comp[q])), find(int(comp[t]))
        if one != other and linked(*(elements[begins[x] : begins[x] + size[x]] for x in (q, t)), percent):
            root[max(one, other)] = min(one, other)
            found[0].append(int(ids[q]))
            found[1].append(int(ids[t]))
    return pa.record_batch([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], names=["a", "b"])


def _without(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", *["kept"] * with_text]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), *[pa.string()] * with_text]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            data = (batch.column(1)[i].as_py() or "").encode()
            gone = sorted((x["place"], x["past"]) for x in batch.column(2)[i].as_py() or [])
            kept, spans = remove(data, gone)
            values = (doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [x[0] for x in gone], kept.decode())
            for column, value in zip(rows, values):
                column.append(value)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)


def paragraph_dedup(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8, percent: int = 75, width: int = 5, with_text: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed (bytes), n_spans, kept_sha256, removed.

    Paragraphs of at least min_words words are linked when the Jaccard similarity of their
    sets of `width`-word shingles is at least percent / 100; of each component of links the
    first paragraph, by document id and place, stays. removed lists the byte offsets at which
    the paragraphs begin that go, with the blanks or newline after them. Text that is in no
    paragraph is never removed. with_text adds the
    remaining text. Null texts are empty. Rows repeated under one id with one text are one
    document and marked alike; a null id comes first in order and stays null. An empty table
    gives an empty result; other columns are ignored.
    """
    if min_words < width:
        raise ValueError("min_words must be at least width")
    scratch = Scratch(spark, "paragraphs")
    text = F.col(f"`{text_col}`")
    bands = bands_needed(percent / 100)
    own = F.col(f"`{id_col}`").cast("long")
    source = docs.select(F.xxhash64(own, text).alias("row"), F.coalesce(own, F.lit(-(2**63))).alias("id"), text.alias("text"), own.alias("own"))
    places = scratch.put(source.select("row", "id", "text").mapInArrow(lambda it: _paragraph_rows(it, min_words), "row long, id long, place long, past long, hi long, lo long"), "places")
    lead = F.struct("id", "row", "place")
    grouped = places.groupBy("hi", "lo").agg(F.min(lead).alias("lead"), F.count("*").alias("copies"))
    # The number of a class is written with it, so it does not change when a task is run again.
    classes = scratch.put(grouped.select(F.monotonically_increasing_id().alias("cls"), "hi", "lo", "copies", "lead"), "classes")
    firsts = classes.groupBy(F.col("lead.row").alias("row"), F.col("lead.id").alias("id")).agg(F.collect_list(F.struct("cls", F.col("lead.place").alias("place"))).alias("listed"))
    texts = source.select("row", "id", "text").join(firsts, ["row", "id"]).select("text", "listed")
    rounds = range(0, bands, AT_ONCE)
    keys = scratch.put(texts.mapInArrow(lambda it: _class_keys(it, min_words, width, bands), ", ".join(["ids binary", *(f"k{k} binary" for k in rounds)])), "keys")
    dealt = max(wide(spark), math.ceil(classes.count() * AT_ONCE / HELD))
    parts = []
    for k in rounds:  # a few bands at a time: what a round shuffles is gone before the next
        blocks = keys.select("ids", f"k{k}").mapInArrow(lambda it: _deal(it, dealt), "part int, keys binary, ids binary, members binary")
        parts.append(scratch.put(blocks.repartitionById(dealt, "part").select("keys", "ids", "members").mapInArrow(_meet, "key long, id long, first long"), f"members{k}"))
    scratch.drop("keys")
    member = reduce(DataFrame.unionByName, parts)
    wanted = classes.join(member.select(F.col("id").alias("cls")).distinct(), "cls").select(F.col("lead.row").alias("row"), F.col("lead.id").alias("id"), F.struct("cls", F.col("lead.place").alias("place")).alias("x"))
    listed = wanted.groupBy("row", "id").agg(F.collect_list("x").alias("listed"))
    texts = source.select("row", "id", "text").join(listed, ["row", "id"]).select("text", "listed")
    sets = scratch.put(texts.mapInArrow(lambda it: _wanted_sets(it, min_words, width, bands), "id long, registers binary, elements binary"), "sets")
    star = member.where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    sides = [sets.select(F.col("id").alias(x), F.col("elements").alias(f"elements_{x}")) for x in "ab"]
    pairs = star.join(sides[0], "a").join(sides[1], "b").select("a", "b", "elements_a", "elements_b")
    links = scratch.put(pairs.mapInArrow(lambda it: _star_links(it, percent), "a long, b long"), "links")
    parts = scratch.put(connected_components(links, scratch, "cc1"), "parts")
    more = scratch.put(residual_links(member.select("key", "id"), sets, parts, percent, in_blocks=_links_in_blocks), "more")
    for name in ("sets", *(f"members{k}" for k in rounds)):
        scratch.drop(name)
    final = parts if more.isEmpty() else connected_components(links.unionByName(more), scratch, "cc2")
    placed = classes.select("cls", "hi", "lo", "copies", "lead").join(final, F.col("cls") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cls"))
    placed = scratch.put(placed.where("copies > 1 OR node IS NOT NULL").drop("node"), "placed")
    keeper = placed.groupBy("component").agg(F.min("lead").alias("keeper"))
    told = placed.join(keeper, "component").select("hi", "lo", "keeper")
    gone = places.join(told, ["hi", "lo"]).where((F.col("id") != F.col("keeper.id")) | (F.col("row") != F.col("keeper.row")) | (F.col("place") != F.col("keeper.place")))
    gone = scratch.put(gone.groupBy("row", "id").agg(F.collect_set(F.struct("place", "past")).alias("removed")), "gone")
    for name in ("places", "classes"):
        scratch.drop(name)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>" + ", kept string" * with_text
    return source.join(gone, ["row", "id"], "left").select("own", "text", "removed").mapInArrow(lambda it: _without(it, with_text), schema)
