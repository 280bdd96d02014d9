"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two in n (whole
`limit`-token pieces first, then the binary digits of the rest, longest first). Every piece
is a sequence by itself, and sequences of one length form a bucket: a batch drawn from a
bucket needs no padding and no sequence holds parts of two documents. Nothing is shuffled:
a document's pieces depend on that document alone.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose ids a worker remembers; beyond that, words longer than SHORT are forgotten.
CACHED_WORDS, SHORT = 900_000, 8
#: Documents whose unseen words are encoded together.
TOGETHER = 512
_LOADED: dict[str, "Words"] = {}
#: How byte-level tokenizers write the bytes that aren't printable Latin-1: from U+0100 on, in order.
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


class Words:
    """Encodes texts word by word with a byte-level BPE that drops white space, remembering words.

    Only for tokenizers that split at blanks, and letters from full stops and commas, before
    merging, and that normalise by NFC and lower case: then a word's ids do not depend on its
    neighbours. Texts are cut at U+0020 and U+000A alone. Words of Latin letters go straight
    to the merges, all others through the whole tokenizer; both ways give the same ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        # The same merges, without the model's own cache: words come here once.
        same = {k: model[k] for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k) is not None}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Tokenizer(models.BPE(vocab=model["vocab"], merges=pairs, cache_capacity=0, **same))
        self.merges.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.known: dict[str, bytes] = {"": b""}

    def _whole(self, words: list[str]) -> dict[str, bytes]:
        got = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return {w: array("I", x.ids).tobytes() for w, x in zip(words, got)}

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words as little-endian unsigned 32-bit integers."""
        found, plain, cores, rest = {}, [], [], []
        for w in words:
            core = w.rstrip(".,")
            if not core.isalpha():
                rest.append(w)
            elif core.isascii():
                plain.append((w, w[len(core) :]))
                cores.append(core.lower())
            elif max(core) < "\u0130":
                plain.append((w, w[len(core) :]))
                cores.append(core.lower().encode().decode("latin-1").translate(_BYTES))
            else:
                rest.append(w)
        tails = {"": b""} | self._whole(list({t for _, t in plain if t}))
        for i in range(0, len(rest), 2048):
            found |= self._whole(rest[i : i + 2048])
        for i in range(0, len(plain), 2048):
            part = plain[i : i + 2048]
            got = self.merges.encode_batch(["\n".join(cores[i : i + 2048])], add_special_tokens=False)[0]
            buffer, at = array("I", got.ids).tobytes(), np.searchsorted(got.word_ids, np.arange(len(part) + 1)) * 4
            ends = at.tolist()
            found.update([(w, buffer[a:b] + tails[tail] if tail else buffer[a:b]) for (w, tail), a, b in zip(part, ends, ends[1:])])
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for i in range(0, len(texts), TOGETHER):
            split = [t.replace("\n", " ").split(" ") for t in texts[i : i + TOGETHER]]
            known = self.known
            fresh = [*set().union(*split).difference(known)]
            if len(known) + len(fresh) > CACHED_WORDS:
                known = self.known = {w: x for w, x in known.items() if len(w) <= SHORT} if len(fresh) < CACHED_WORDS // 2 else {"": b""}
                if len(known) > CACHED_WORDS // 2:
                    known = self.known = {"": b""}
                fresh = [*set().union(*split).difference(known)]
            known.update(self.learn(fresh))
            for words in split:
                yield b"".join(map(known.__getitem__, words))
            for w in fresh:
                if len(w) > 64:
                    del known[w]


def words_of(path: str) -> Words:
    if path not in _LOADED:
        _LOADED[path] = Words(path)
    return _LOADED[path]


def piece_lengths(n: int, limit: int) -> list[int]:
    """Powers of two that add up to n, none above limit (itself a power of two), longest first."""
    whole, rest = divmod(n, limit)
    return [limit] * whole + [1 << k for k in reversed(range(limit.bit_length() - 1)) if rest >> k & 1]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, limit: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    words, end = words_of(path), end_id.to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    for batch in (whole.slice(i, 2000) for whole in batches for i in range(0, whole.num_rows, 2000)):
        rows: list[list] = [[] for _ in names]
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for doc_id, ids in zip(batch.column(0).to_pylist(), words.encode(texts)):
            ids += end
            n, start = len(ids) // 4, 0
            for length in piece_lengths(n, limit):
                piece = ids[4 * start : 4 * (start + length)]
                for column, value in zip(rows, (doc_id, start, length, crc32(piece), n, piece)):
                    column.append(value)
                start += length
        kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)


def pack(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket.

    Every document ends with end_id, so a null or empty text is one piece of length 1. Each
    id lies in exactly one piece; a piece is a whole sequence (offset 0) and needs no
    padding. bucket is log2 of the length: write partitioned by it to get the equal-length
    buckets. sequence_id is unique within one result. with_ids adds the ids as
    little-endian unsigned 32-bit integers. Rows repeated under one id are packed each; a
    null id stays null. An empty table gives an empty result; other columns are ignored.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    cut = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(lambda it: _pieces(it, tokenizer_path, limit, end_id, with_ids), schema)
    return cut.select(
        *[F.col(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")],
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("long").alias("bucket"),
        *["ids"] * with_ids,
    )
