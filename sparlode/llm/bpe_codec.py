"""Byte-level BPE encoding and decoding by recursive queries in DuckDB.

Each Python worker holds one in-memory DuckDB with the vocabulary and a merge table: every
way to put a token together from two others, with the token's rank. The distinct unseen
pre-tokens of a batch of texts become token-position rows, one byte each; a recursive query
joins neighbouring positions with the merge table and contracts, in each word, its leftmost
pair of minimum rank, until no pair of any word is in the table. Ordered aggregation gives
the ids of each word, and from ids and the vocabulary the bytes again.

Contracting every occurrence of the minimum-rank pair in one step equals doing so one by one
from the left unless the new token can join a neighbour into one of lower rank. Ranks for
which a lower-ranked token starts or ends with the new token are marked, and only the
leftmost occurrence is contracted for these. So a long unbroken word takes as many steps as
it has different merges, not as many as it has merges; and it is cut beforehand between bytes
that no token holds side by side, as no merge reaches across.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens a worker remembers; the longest one remembered, and the longest one kept when there are too many.
CACHED, REMEMBERED_LENGTH, SHORT = 900_000, 64, 7
#: Pre-tokens per query, and characters of text whose unseen pre-tokens are encoded together.
PER_QUERY, TOGETHER = 20_000, 3_000_000
#: Token-position rows that one query may make over all its steps, unless one step has more.
STEP_ROWS = 4_000_000
#: Memory of the database; nothing is written to a local disk.
MEMORY = "512MB"
_LOADED: dict[tuple[str, str], "Codec"] = {}

#: spot: offset in the texts of all words together, with a gap after each word; a token's neighbour is at spot + size.
STEPS = """
WITH RECURSIVE step(round, word, spot, token, size) AS (
    SELECT 0, word, spot, token, size FROM start
    UNION ALL
    (WITH pair AS (
        SELECT n.word, n.spot, n.size, n.spot + n.size AS next_spot, n.size + o.size AS span, m.rank, m.alone
        FROM step n JOIN step o ON o.spot = n.spot + n.size JOIN merges m ON m.lr = (n.token << 32) | o.token
        WHERE n.round < $most
    ), lowest AS (
        SELECT word, min(rank) AS rank FROM pair GROUP BY word
    ), hit AS (
        SELECT p.word, p.spot, p.next_spot, p.span, p.rank, p.alone,
               lag(p.next_spot) OVER near AS touched, row_number() OVER near AS nth
        FROM pair p JOIN lowest x ON x.word = p.word AND x.rank = p.rank
        WINDOW near AS (PARTITION BY p.word ORDER BY p.spot)
    ), apart AS (
        SELECT *, nth - max(CASE WHEN touched = spot THEN 0 ELSE nth END) OVER (PARTITION BY word ORDER BY spot) AS in_run FROM hit
    ), merge AS (
        SELECT spot, next_spot, span, rank FROM apart WHERE in_run % 2 = 0 AND (nth = 1 OR NOT alone)
    )
    SELECT n.round + 1, n.word, n.spot, coalesce(a.rank, n.token), coalesce(a.span, n.size)
    FROM step n
    JOIN lowest x ON x.word = n.word
    LEFT JOIN merge a ON a.spot = n.spot
    ANTI JOIN merge b ON b.next_spot = n.spot)
), final AS (
    SELECT word, max(round) AS round FROM step GROUP BY word
)
"""
CONTRACT = STEPS + """
SELECT s.word, string_agg(CAST(s.token AS VARCHAR), ' ' ORDER BY s.spot) AS ids, any_value(s.round) AS round
FROM step s JOIN final USING (word, round) GROUP BY s.word ORDER BY s.word
"""
ADVANCE = "CREATE OR REPLACE TEMP TABLE reached AS " + STEPS + "SELECT s.* FROM step s JOIN final USING (word, round)"
FINISHED = "SELECT word, string_agg(CAST(token AS VARCHAR), ' ' ORDER BY spot) FROM reached WHERE round < $most GROUP BY word"
GO_ON = "CREATE OR REPLACE TEMP TABLE start AS SELECT word, spot, token, size FROM reached WHERE round = $most"
DECODE = """
SELECT t.word, string_agg(v.hex, '' ORDER BY t.place) AS hex
FROM (SELECT word, unnest(ids) AS id, generate_subscripts(ids, 1) AS place FROM
      (SELECT word, CAST(string_split(ids, ' ') AS INTEGER[]) AS ids FROM encoded)) t
JOIN vocabulary v USING (id) GROUP BY t.word ORDER BY t.word
"""


class Codec:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": MEMORY, "temp_directory": ""})
        pair, rank, alone = [], [], []
        ends = self._held_below()
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pair.append(a << 32 | b)
                    rank.append(r)
                    alone.append(r in ends)
        self._load("merges", lr=pa.array(pair, pa.int64()), rank=pa.array(rank, pa.int32()), alone=pa.array(alone))
        self._load("vocabulary", id=pa.array(list(self.ranks.values()), pa.int32()), hex=pa.array([t.hex() for t in self.ranks]))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.bridged = self._bridged()
        self.known: dict[str, tuple[bytes, bytes]] = {}  # pre-token -> ids (decimal, joined by blanks), the bytes they decode to

    def _held_below(self) -> set[int]:
        """Ranks whose token starts or ends a token of lower rank."""
        found = set()
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                for part in (token[:i], token[i:]):
                    if self.ranks.get(part, -1) > r:
                        found.add(self.ranks[part])
        return found

    def _bridged(self) -> np.ndarray:
        """Pairs of bytes that stand side by side in some token; no merge ever joins other pairs."""
        found = np.zeros((256, 256), dtype=bool)
        for token in self.ranks:
            raw = np.frombuffer(token, dtype=np.uint8)
            found[raw[:-1], raw[1:]] = True
        return found

    def apart(self, word: bytes) -> list[bytes]:
        """A word cut where no merge can reach across: the pieces are encoded each by itself."""
        raw = np.frombuffer(word, dtype=np.uint8)
        cuts = [0, *(np.flatnonzero(~self.bridged[raw[:-1], raw[1:]]) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def _load(self, name: str, **columns) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _start(self, words: list[bytes]) -> int:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        spot = np.arange(len(flat), dtype=np.int64) + word
        self._load("start", word=pa.array(word), spot=pa.array(spot), token=pa.array(self.byte_ids[flat].astype(np.int64)), size=pa.array(np.ones(len(flat), dtype=np.int32)))
        return len(flat)

    def contracted(self, words: list[bytes]) -> list[str]:
        """The ids of each word, in decimal, joined by blanks; long words go in pieces."""
        split = [self.apart(w) if len(w) > REMEMBERED_LENGTH else [w] for w in words]
        pieces = sorted({p for ps in split for p in ps}, key=len)
        found: dict[bytes, str] = {}
        for i in range(0, len(pieces), PER_QUERY):
            part = pieces[i : i + PER_QUERY]
            found.update(zip(part, self.contract(part)))
        return [" ".join([found[p] for p in ps]) for ps in split]

    def contract(self, words: list[bytes]) -> list[str]:
        """The ids of each word, in decimal, joined by blanks."""
        most = STEP_ROWS // max(1, self._start(words))
        if most < 16:
            return self._at_length(words)
        got = self.db.execute(CONTRACT, {"most": most}).fetchall()
        out = [ids for _, ids, _ in got]
        if late := [k for k, x in enumerate(got) if x[2] == most]:
            for k, ids in zip(late, self._at_length([words[k] for k in late])):
                out[k] = ids
        return out

    def _at_length(self, words: list[bytes]) -> list[str]:
        """The same for words that take many steps: each query goes on from where the last one stopped, so rows of old steps don't pile up."""
        out, rows = [""] * len(words), self._start(words)
        while rows:
            most = {"most": max(1, STEP_ROWS // rows)}
            self.db.execute(ADVANCE, most)
            for word, ids in self.db.execute(FINISHED, most).fetchall():
                out[word] = ids
            self.db.execute(GO_ON, most)
            rows = self.db.execute("SELECT count(*) FROM start").fetchall()[0][0]
        return out

    def decode(self, encoded: list[str]) -> list[bytes]:
        """The bytes of each list of ids (decimal, joined by blanks, at least one)."""
        self._load("encoded", word=pa.array(range(len(encoded)), pa.int32()), ids=pa.array(encoded, pa.string()))
        return [bytes.fromhex(x[1]) for x in self.db.execute(DECODE).fetchall()]

    def learn(self, words: list[str]) -> None:
        for i in range(0, len(words), PER_QUERY):
            part = words[i : i + PER_QUERY]
            raw = [w.encode() for w in part]
            # A pre-token that is itself in the vocabulary is that token, whatever its merges give.
            whole = [self.ranks.get(b) for b in raw]
            rest = [k for k, r in enumerate(whole) if r is None]
            ids = [str(r) for r in whole]
            if rest:
                for k, got in zip(rest, self.contracted([raw[k] for k in rest])):
                    ids[k] = got
            self.known.update(zip(part, zip([x.encode() for x in ids], self.decode(ids))))

    def round_trip(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids (decimal, joined by blanks) and the bytes that these decode to."""
        for part in _portions(texts):
            split = [self.split(t) for t in part]
            if len(self.known) > CACHED:
                self.known = {w: x for w, x in self.known.items() if len(w) <= SHORT}
                if len(self.known) > CACHED // 2:
                    self.known = {}
            fresh = sorted(set().union(*split).difference(self.known), key=len)
            self.learn(fresh)
            for words in split:
                found = list(map(self.known.__getitem__, words))
                yield b" ".join([x[0] for x in found]), b"".join([x[1] for x in found])
            for w in reversed(fresh):
                if len(w) <= REMEMBERED_LENGTH:
                    break
                del self.known[w]


def _portions(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= TOGETHER:
            yield part
            part, size = [], 0
    yield part


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tool = codec(path, pattern)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids", "decoded"] * with_ids]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.string(), pa.binary()] * with_ids]
    for batch in batches:
        rows: list[list] = [[] for _ in names]
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for doc_id, (ids, decoded) in zip(batch.column(0).to_pylist(), tool.round_trip(texts)):
            values = (doc_id, ids.count(b" ") + bool(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest(), ids.decode(), decoded)
            for column, value in zip(rows, values):
                column.append(value)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)


def encode_decode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Texts are split by `pattern` and each match is encoded by the ranks in `rank_path`, with
    no special tokens; the ids are then decoded. Null and empty texts have no token, and span
    digests are those of the empty string. with_ids adds the ids (decimal, joined by blanks)
    and the decoded bytes. Rows repeated under one id are encoded each; a null id stays null.
    An empty table gives an empty result; other columns are ignored.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded binary" * with_ids
    source = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"))
    return source.mapInArrow(lambda it: _encoded(it, rank_path, pattern, with_ids), schema)
