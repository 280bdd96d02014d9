"""Removal of repeated substrings by longest-previous-factor arrays.

A string of `length` bytes that occurs twice is found without a global suffix array. Each
window of that many bytes belongs to the bucket named by the smallest hash of its short
substrings, so equal windows share a bucket wherever they are. Consecutive windows of one
bucket are one segment. Per bucket:

* one segment, its bucket's hash only once in it: nothing in it can repeat;
* segments that are all equal: copies of one text, whose windows all repeat;
* else the distinct segments go to one task, with those of other buckets, as one
  concatenated text in document order. Previous and next smaller positions in its suffix
  order give each position's longest previous factor; a window repeats an earlier one where
  that reaches the window's length, and the place it comes from repeats too;
* a bucket with very many distinct segments (a passage that is common in different
  surroundings) is divided by the windows' own hashes until equal windows alone are
  together; of these all but the first have a previous factor of full length.

Segments and windows are compared by 128-bit hashes (XXH3), so copies of a text cost one row
each and no group of copies meets in a task. Documents are known by identifier and a hash of
their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import Scratch, wide
from .shingles import mix
from .suffix_array import concatenate, repeated_starts

#: Bytes of a substring that names a bucket, most windows in a segment, bytes of a document handled at once.
GRAM, LONGEST, CHUNK = 64, 4096, 1 << 20
#: Distinct segments from which a bucket is divided by windows, and bytes that are sorted together.
CROWDED, TOGETHER = 1000, 1_000_000
_rng = np.random.default_rng(20240301)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, 1 << 16), b, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def gram_hashes(data: bytes, size: int) -> np.ndarray:
    """A hash of every substring of `size` bytes. It names buckets only: different substrings with one hash share a bucket, no more."""
    raw = np.frombuffer(data, dtype=np.uint8)
    power, inverse = _powers(len(raw) + 1)
    s = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[raw] * inverse[: len(raw)], out=s[1:])
    n = len(s) - size
    return mix((s[size:] - s[:-size]) * power[:n] + np.uint64(size))


def content_hashes(data: bytes, starts: Iterable[int], ends: Iterable[int]) -> np.ndarray:
    """128-bit hashes of the bytes from each start to each end, as two columns."""
    return np.frombuffer(b"".join([xxh3_128_digest(data[a:b]) for a, b in zip(starts, ends)]), dtype=np.int64).reshape(-1, 2)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def segments(data: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Segments of a document: bucket, first window, last window, two content hashes, whether the bucket's hash occurs in it more than once."""
    gram = min(GRAM, length)
    out: list[list[np.ndarray]] = [[], [], [], [], [], []]
    last = len(data) - length + 1  # number of windows
    for base in range(0, max(0, last), CHUNK):
        part = data[base : base + CHUNK + length - 1]
        grams = gram_hashes(part, gram)
        span = length - gram + 1
        low = sliding_minimum(grams, span)
        cuts = np.flatnonzero(low[1:] != low[:-1]) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [len(low)]])  # exclusive
        many = np.zeros(len(starts), dtype=bool)
        for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            first = a + int(grams[a : a + span].argmin())
            final = b - 1 + span - 1 - int(grams[b - 1 : b - 1 + span][::-1].argmin())
            many[i] = first != final
        if (ends - starts).max() > LONGEST:
            cut = [(s, min(s + LONGEST, b), m) for a, b, m in zip(starts.tolist(), ends.tolist(), many.tolist()) for s in range(a, b, LONGEST)]
            starts, ends, many = np.array([c[0] for c in cut]), np.array([c[1] for c in cut]), np.array([c[2] for c in cut])
        content = content_hashes(part, starts.tolist(), (ends - 1 + length).tolist())
        for column, x in zip(out, (low[starts], starts + base, ends - 1 + base, content[:, 0], content[:, 1], many)):
            column.append(x)
    if not out[0]:
        return tuple(np.zeros(0, dtype=k) for k in (np.uint64, np.int64, np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(c) for c in out)


def _segment_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    names = ["row", "id", "bucket", "first", "last", "c1", "c2", "many"]
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            rows, ids, found = [], [], []
            for row, doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                data = (text.as_py() or "").encode()
                if len(data) >= length:
                    got = segments(data, length)
                    rows.append(np.full(len(got[0]), row, dtype=np.int64))
                    ids.extend([doc_id] * len(got[0]))
                    found.append(got)
            if found:
                columns = [np.concatenate(c) for c in zip(*found)]
                signed = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
                yield pa.record_batch([pa.array(np.concatenate(rows)), pa.array(ids, pa.int64()), *[pa.array(c) for c in signed]], names=names)


SEGMENTS = "row long, id long, bucket long, first long, last long, c1 long, c2 long, many boolean"


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed segments of each document."""
    names = ["bucket", "c1", "c2", "id", "row", "first", "copies", "data"]
    for batch in batches:
        for i in range(batch.num_rows):
            data = (batch.column(1)[i].as_py() or "").encode()
            doc = batch.column(0)[i].as_py()
            listed = batch.column(2)[i].as_py()
            rows = [(x["bucket"], x["c1"], x["c2"], x["id"], doc, x["first"], x["copies"], data[x["first"] : x["last"] + length]) for x in listed]
            if rows:
                kinds = [pa.int64()] * 7 + [pa.binary()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _runs(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The byte ranges that windows with a flag cover."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > length)
    begins, ends = np.concatenate([[at[0]], at[breaks + 1]]), np.concatenate([at[breaks], [at[-1]]]) + length
    return list(zip(begins.tolist(), ends.tolist()))


def _sorted_together(batches: Iterator[pa.RecordBatch], length: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Repeated ranges within segments; rows come by bucket and, in a bucket, in document order."""
    names = ["bucket", "c1", "c2", "begin", "end"]
    waiting: list[tuple] = []
    size = 0

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        out: list[tuple] = []
        symbols, begins = concatenate([r[4] for r in rows])
        later, anywhere = repeated_starts(symbols, length)
        for (bucket, c1, c2, copies, data), begin in zip(rows, begins.tolist()):
            windows = slice(begin, begin + len(data) - length + 1)
            # The first copy of a segment is judged by what precedes it; other copies repeat as a whole.
            flags = later[windows] if keep_first else anywhere[windows] | (copies > 1)
            out.extend((bucket, c1, c2, a, b) for a, b in _runs(flags, length))
        columns = list(zip(*out)) or [()] * 5
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("bucket", "c1", "c2", "copies", "data"))):
            if waiting and waiting[-1][:3] == row[:3]:
                continue  # from a repeated row of the same document
            if size >= TOGETHER and waiting[-1][0] != row[0]:
                yield settle(waiting)
                waiting, size = [], 0
            waiting.append(row)
            size += len(row[4])
    if waiting:
        yield settle(waiting)


def _windows(batches: Iterator[pa.RecordBatch], length: int, placed: bool) -> Iterator[pa.RecordBatch]:
    """A row for every window of a segment: its hash, the segment's number, where it begins there; placed adds its place in document order."""
    names = ["w1", "w2", "segment", "begin", *["id", "row", "spot"] * placed]
    for batch in batches:
        for segment, doc, row, first, data in zip(*(batch.column(k).to_pylist() for k in ("segment", "id", "row", "first", "data"))):
            n = len(data) - length + 1
            w = content_hashes(data, range(n), range(length, length + n))
            columns = [w[:, 0], w[:, 1], np.full(n, segment), np.arange(n), *[np.full(n, doc), np.full(n, row), np.arange(n) + first] * placed]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)


def _merged(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The byte ranges of a segment's repeated windows, neighbours joined."""
    for batch in batches:
        ranges = []
        for begins in batch.column(1):
            flags = np.zeros(1 + max(begins.as_py()), dtype=bool)
            flags[begins.as_py()] = True
            ranges.append([{"begin": a, "end": b} for a, b in _runs(flags, length)])
        yield pa.record_batch([batch.column(0), pa.array(ranges, _RANGES)], names=["segment", "ranges"])


_RANGES = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "spans"] * with_text]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.binary(), _RANGES] * with_text]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            data = (batch.column(1)[i].as_py() or "").encode()
            kept, spans = remove(data, [(s["begin"], s["end"]) for s in batch.column(2)[i].as_py() or []])
            values = (doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, [{"begin": a, "end": b} for a, b in spans])
            for column, value in zip(rows, values):
                column.append(value)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)


def remove(data: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What stays of data without the ranges, and the maximal removed runs."""
    runs: list[list[int]] = []
    for a, b in sorted(ranges):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), [(a, b) for a, b in runs]


def suffix_dedup(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, keep_first: bool = True, with_text: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Each byte covered by a string of `length` bytes that also starts elsewhere is removed;
    with keep_first only if it also starts earlier (documents in order of id, then position),
    so one copy stays. Strings are judged on the input, do not cross documents, and may
    overlap. Texts are UTF-8 bytes, null is empty; texts shorter than `length` stay whole.
    with_text adds the remaining bytes and the removed runs. Rows repeated under one id are
    separate documents. A null id comes first in order and stays null. An empty table gives
    an empty result; other columns are ignored.
    """
    scratch = Scratch(spark, "suffix")
    text = F.col(f"`{text_col}`")
    own = F.col(f"`{id_col}`").cast("long")
    source = docs.select(F.xxhash64(own, text).alias("row"), F.coalesce(own, F.lit(-(2**63))).alias("id"), text.alias("text"), own.alias("own"))
    every = scratch.put(source.select("row", "id", "text").mapInArrow(lambda it: _segment_rows(it, length), SEGMENTS), "segments")
    place = F.struct("id", "row", "first")
    told = every.groupBy("bucket").agg(
        F.count("*").alias("n"), (F.min("c1").eqNullSafe(F.max("c1")) & F.min("c2").eqNullSafe(F.max("c2"))).alias("equal"), F.max("many").alias("many"), F.min(place).alias("lead")
    ).where("n > 1 OR many")
    found = scratch.put(every.join(told.select("bucket", "n", (F.col("equal") & ~F.col("many")).alias("equal"), "lead"), "bucket"), "found")
    # Buckets of equal segments: all repeat, or all but the first.
    whole = found.where("equal" if not keep_first else F.col("equal") & (place != F.col("lead"))).select("row", "id", F.array(F.struct(F.col("first").alias("begin"), (F.col("last") + length).alias("end"))).alias("ranges"))
    mixed = found.where("NOT equal").select(*every.columns)
    heads = mixed.groupBy("bucket", "c1", "c2").agg(F.count("*").alias("copies"), F.min(F.struct("id", "row", "first", "last")).alias("r"))
    heads = scratch.put(heads.select("bucket", "c1", "c2", "copies", "r.id", "r.row", "r.first", "r.last"), "heads")
    listed = heads.groupBy("row", "id").agg(F.collect_list(F.struct("bucket", "c1", "c2", "id", "first", "last", "copies")).alias("listed"))
    bytes_ = source.select("row", "id", "text").join(listed, ["row", "id"]).select("row", "text", "listed")
    cut = scratch.put(bytes_.mapInArrow(lambda it: _cut_out(it, length), "bucket long, c1 long, c2 long, id long, row long, first long, copies long, data binary"), "cut")
    crowded = scratch.put(heads.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("bucket"), "crowded")
    calm = cut.join(crowded, "bucket", "left_anti").repartition(wide(spark), "bucket").sortWithinPartitions("bucket", "id", "row", "first")
    ranges = calm.mapInArrow(lambda it: _sorted_together(it, length, keep_first), "bucket long, c1 long, c2 long, begin long, end long")
    ranges = ranges.groupBy("bucket", "c1", "c2").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    # The number of a segment is written with it, so it does not change when a task is run again.
    crowd = scratch.put(cut.join(crowded, "bucket").withColumn("segment", F.monotonically_increasing_id()), "crowd")
    windows = scratch.put(crowd.mapInArrow(lambda it: _windows(it, length, keep_first), "w1 long, w2 long, segment long, begin long" + ", id long, row long, spot long" * keep_first), "windows")
    if keep_first:
        spot = F.struct("id", "row", "spot")
        seen = windows.groupBy("w1", "w2").agg(F.count("*").alias("met"), F.min(spot).alias("earliest")).where("met > 1")
        divided = windows.join(seen, ["w1", "w2"]).where(spot != F.col("earliest"))
    else:
        divided = windows.join(windows.groupBy("w1", "w2").agg(F.count("*").alias("met")).where("met > 1"), ["w1", "w2"])
    begins = divided.groupBy("segment").agg(F.collect_set("begin").alias("begins")).mapInArrow(lambda it: _merged(it, length), "segment long, ranges array<struct<begin: long, end: long>>")
    ranges = ranges.unionByName(crowd.select("segment", "bucket", "c1", "c2").join(begins, "segment").drop("segment"))
    if not keep_first:  # segments with copies repeat as a whole
        all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.octet_length("data").cast("long").alias("end")))
        ranges = ranges.unionByName(crowd.where("copies > 1").select("bucket", "c1", "c2", all_of_it.alias("ranges")))
    marked = mixed.join(ranges, ["bucket", "c1", "c2"])
    if keep_first:  # copies after the first repeat as a whole
        lead = heads.select("bucket", "c1", "c2", place.alias("lead"))
        marked = mixed.join(lead, ["bucket", "c1", "c2"]).join(ranges, ["bucket", "c1", "c2"], "left")
        all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("begin"), (F.col("last") - F.col("first") + length).alias("end")))
        marked = marked.withColumn("ranges", F.when(place != F.col("lead"), all_of_it).otherwise(F.col("ranges"))).where("ranges IS NOT NULL")
    inside = marked.select("row", "id", F.transform("ranges", lambda x: F.struct((x["begin"] + F.col("first")).alias("begin"), (x["end"] + F.col("first")).alias("end"))).alias("ranges"))
    gone = scratch.put(whole.unionByName(inside).groupBy("row", "id").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "gone")
    for name in ("segments", "found", "cut", "crowd", "windows"):
        scratch.drop(name)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary, spans array<struct<begin: long, end: long>>" * with_text
    return source.join(gone, ["row", "id"], "left").select("own", "text", "ranges").mapInArrow(lambda it: _removed(it, with_text), schema)
