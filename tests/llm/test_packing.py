from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

import sparlode.llm.packing as module
from sparlode.llm.common import tokenizer_file
from sparlode.llm.packing import Words, pack, piece_lengths

from .conftest import LONG

PATH = tokenizer_file("word_bpe_49k.json")
ODD = ["", "a  b\n\n c", "Σας ΟΔΟΣ Σ", "é ́x á", "x\x1cy\x85z q", "don't I'll <|endoftext|> x<|startoftext|>y", "한글 日本 ١٢٣", "tab\tsep\rx ªº µ ñ.,. Ärz, ÿ. ŉ İx ß, a.b,c", "ab" * 3000, "...,,, ,", "😀 👍🏽 ﬁ"]


def test_words_give_the_tokenizers_ids(monkeypatch):
    whole = Tokenizer.from_file(PATH)
    want = [whole.encode(t, add_special_tokens=False).ids for t in ODD]
    assert [np.frombuffer(x, "<u4").tolist() for x in Words(PATH).encode(ODD)] == want
    monkeypatch.setattr(module, "CACHED_WORDS", 4)
    monkeypatch.setattr(module, "TOGETHER", 2)
    words = Words(PATH)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode(ODD)] == want
    assert all(len(w) <= 64 for w in words.known)


@pytest.mark.parametrize("limit", [1, 8, 2048])
def test_piece_lengths(limit):
    for n in range(1, 300):
        got = piece_lengths(n, limit)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= limit for x in got) and got == sorted(got, reverse=True)
        assert len(set(got) - {limit}) == len([x for x in got if x != limit])


def test_pieces(shipped, docs):
    rows = list(enumerate(ODD)) + [(50, None), (51, LONG), (51, "again"), (None, "no id")]
    got = pack(docs(rows), PATH, limit=64, with_ids=True).collect()
    whole = Tokenizer.from_file(PATH)
    pieces = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = [(i, whole.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    assert sorted((str(i), len(x)) for i, x in want) == sorted((str(i), n) for i, n in pieces)
    for i, ids in want:
        own = sorted(pieces[i, len(ids)], key=lambda r: r.start)
        joined = b"".join(bytes(r.ids) for r in own)
        assert np.frombuffer(joined, "<u4").tolist() == ids
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert all(r.ids_crc32 == crc32(bytes(r.ids)) and r.offset == 0 and r.length == 1 << r.bucket and r.length <= 64 for r in own)
    assert len({r.sequence_id for r in got}) == len(got)


def test_edges(shipped, docs):
    assert pack(docs([]), PATH).count() == 0
    with pytest.raises(ValueError):
        pack(docs([]), PATH, limit=100)
