import base64
import hashlib
import random

import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import sparlode.llm.bpe_codec as module
from sparlode.llm.bpe_codec import Codec, codec, encode_decode
from sparlode.llm.common import splitting_pattern, tokenizer_file

from .conftest import LONG, by_id

PATH, PATTERN = tokenizer_file("byte_bpe_50k.tiktoken"), splitting_pattern()
TOOL = codec(PATH, PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=TOOL.ranks, special_tokens={})
ODD = ["", "a" * 3000, "ab" * 999, "abcabcabd" * 200, "x\x1cy\x85z  q \n\n ", "日本語テキスト한글 ١٢٣", "<|endoftext|> don't I'll  ", "  \t \x1d\x1e\x1f ​  a", "=====-----" * 50 + "!!!!!!!!"]


def check(text, got):
    assert got == (" ".join(map(str, REFERENCE.encode_ordinary(text))).encode(), text.encode())


def test_odd_texts():
    rng = random.Random(1)
    texts = [*ODD, "".join(rng.choice("abcdefghij") for _ in range(5000)), "".join(chr(rng.randrange(32, 0x3000)) for _ in range(3000))]
    for text, got in zip(texts, TOOL.round_trip(texts), strict=True):
        check(text, got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    for text, got in zip(texts, TOOL.round_trip(texts), strict=True):
        check(text, got)


def test_long_words_within_memory():
    """Words of a megabyte, in a database that may not write to disk."""
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "ab" * 500_000, "=" * 1_000_000]
    tool = Codec(PATH, PATTERN)
    assert tool.db.execute("SELECT current_setting('temp_directory')").fetchall()[0][0] == ""
    for word, (ids, decoded) in zip(words, tool.round_trip(words), strict=True):
        assert decoded == word.encode()
        if word[0] != "=":  # cut where no merge reaches across, so the library, which is slow on long words, can check pieces
            assert ids.decode().split() == [str(x) for p in tool.apart(word.encode()) if len(p) < 1000 for x in REFERENCE._encode_single_piece(p)] or len(tool.apart(word.encode())) == 1


def test_many_ids(tmp_path):
    """More than 65,536 ids: pairs are told apart by the whole of both."""
    tokens = [bytes([b]) for b in range(256)]
    letters = [bytes([b]) for b in range(97, 123)]
    tokens += [a + b for a in letters for b in letters]
    tokens += [a + b + c for a in letters for b in letters for c in letters]
    rng, seen = random.Random(3), set(tokens)
    while len(tokens) < 90_000:
        t = rng.choice(tokens[1000:18000]) + rng.choice(letters)
        if t not in seen and len(t) == 4:
            seen.add(t)
            tokens.append(t)
    rng2 = list(tokens[256:])
    rng.shuffle(rng2)
    order = tokens[:256] + sorted(rng2, key=len)
    path = tmp_path / "many.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(order)))
    tool = Codec(str(path), PATTERN)
    own = tiktoken.Encoding("many", pat_str=PATTERN, mergeable_ranks=tool.ranks, special_tokens={})
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(300)]
    for text, (ids, decoded) in zip(texts, tool.round_trip(texts), strict=True):
        assert ids.decode().split() == [str(x) for x in own.encode_ordinary(text)] and decoded == text.encode()


def test_small_batches_and_forgetting(monkeypatch):
    monkeypatch.setattr(module, "CACHED", 3)
    monkeypatch.setattr(module, "TOGETHER", 10)
    monkeypatch.setattr(module, "PER_QUERY", 2)
    tool = Codec(PATH, PATTERN)
    for _ in range(2):
        for text, got in zip(ODD, tool.round_trip(ODD), strict=True):
            check(text, got)


def test_documents(shipped, docs):
    rows = list(enumerate(ODD)) + [(50, None), (51, LONG), (51, "again"), (None, "no id")]
    got = by_id(encode_decode(docs(rows), PATH, PATTERN, with_ids=True), "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    want = {}
    for i, t in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        line = " ".join(map(str, ids))
        want.setdefault(i, []).append((len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), line))
    assert got == {i: sorted(v, key=str) for i, v in want.items()}
    assert encode_decode(docs([]), PATH, PATTERN).count() == 0
