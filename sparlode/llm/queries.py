"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, toxicity
from .bpe_codec import encode_decode
from .common import crc_remainder, read_table, ship, splitting_pattern, tokenizer_file
from .embedding_dedup import embedding_dedup
from .exact_dedup import exact_dedup
from .packing import pack
from .paragraph_dedup import paragraph_dedup
from .pii import replace_pii, surrogate_key
from .setsketch import near_dedup
from .suffix_dedup import suffix_dedup


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents stay when equal texts keep the largest doc_id."""
    return exact_dedup(spark, read_table(spark, sf_dir, "documents"), keep="max")


OP1_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op4_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingles reach a Jaccard similarity of 0.75."""
    ship(spark)
    return near_dedup(spark, read_table(spark, sf_dir, "documents"))


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without paragraphs that repeat an earlier one."""
    ship(spark)
    return paragraph_dedup(spark, read_table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.95 or more."""
    ship(spark)
    return embedding_dedup(spark, read_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as power-of-two pieces of at most 2048 tokens."""
    ship(spark)
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    ship(spark)
    return replace_pii(read_table(spark, sf_dir, "documents"), surrogate_key(spark))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by byte-level BPE ranks and decoded again."""
    ship(spark)
    return encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), splitting_pattern())


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that occur more than once."""
    ship(spark)
    return suffix_dedup(spark, read_table(spark, sf_dir, "documents"), keep_first=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the labels that aren't held out."""
    ship(spark)
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    index = toxicity.fit(spark, docs, labels.where(crc_remainder("doc_id", 4) != 2))
    found = toxicity.score(spark, docs, index)
    return found.withColumn("held_out", F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of all documents, learnt from those that aren't held out."""
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(crc_remainder("doc_id", 3) != 1))
    found = language_id.identify(spark, docs, model)
    return found.withColumn("held_out", F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False)))


#: Words, distinct shingles, pairs by shared shingle, then everything reachable; for small tables.
OP4_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                                        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s
    FROM split
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
    SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), way AS (
    SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, w.v FROM reach r JOIN way w ON w.u = r.other
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP5_SQL = r"""
WITH RECURSIVE piece AS (
    SELECT doc_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS k
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\n]*?[.!?][ \t]+\n?|[^\n]*\n|[^\n]+') AS ps FROM documents)
), counted AS (
    SELECT *, len(regexp_extract_all(p, '[^\x20\x09-\x0D]+')) >= 8 AS long FROM piece
), begun AS (
    SELECT *, long OR coalesce(lag(long) OVER w, TRUE) OR suffix(lag(p) OVER w, chr(10)) AS opens, coalesce(sum(strlen(p)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spot
    FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), numbered AS (
    SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM begun
), split AS (
    SELECT doc_id, run, CAST(min(spot) AS BIGINT) AS place, string_agg(p, '' ORDER BY k) AS piece,
           regexp_extract_all(translate(string_agg(p, '' ORDER BY k), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM numbered GROUP BY doc_id, run
), para AS (
    SELECT row_number() OVER (ORDER BY doc_id, place) AS pid, doc_id, place, words FROM split WHERE len(words) >= 8
), shingle AS (
    SELECT DISTINCT pid, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS s FROM para
), size AS (
    SELECT pid, count(*) AS n FROM shingle GROUP BY pid
), pair AS (
    SELECT a.pid AS a, b.pid AS b, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.pid < b.pid GROUP BY ALL
), link AS (
    SELECT a, b FROM pair JOIN size x ON x.pid = a JOIN size y ON y.pid = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), way AS (
    SELECT a AS u, b AS v FROM link UNION ALL SELECT b, a FROM link
), reach(pid, other) AS (
    SELECT pid, pid FROM para UNION SELECT r.pid, w.v FROM reach r JOIN way w ON w.u = r.other
), gone AS (
    SELECT p.doc_id, p.place FROM para p JOIN reach r USING (pid) GROUP BY p.pid, p.doc_id, p.place HAVING min(r.other) <> p.pid
), marked AS (
    SELECT s.*, g.place IS NOT NULL AS out FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.place = s.place
), runs AS (
    SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY place), FALSE) AS opens FROM marked
)
SELECT d.doc_id, any_value(strlen(coalesce(d.text, ''))) AS n_bytes, CAST(coalesce(sum(strlen(piece)) FILTER (WHERE out), 0) AS BIGINT) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
       sha256(coalesce(string_agg(piece, '' ORDER BY place) FILTER (WHERE NOT out), '')) AS kept_sha256,
       coalesce(list(place ORDER BY place) FILTER (WHERE out), []) AS removed
FROM documents d LEFT JOIN runs ON runs.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP6_SQL = """
WITH RECURSIVE vec AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), way AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM vec a JOIN vec b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, w.v FROM reach r JOIN way w ON w.u = r.other
)
SELECT vec_id, (SELECT count(*) FROM way WHERE u = r.vec_id) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach r GROUP BY vec_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_setsketch_near_dedup": op4_setsketch_near_dedup,
        "op5_paragraph_dedup": op5_paragraph_dedup,
        "op6_embedding_near_dedup": op6_embedding_near_dedup,
        "op7_packing": op7_packing,
        "op8_pii_surrogates": op8_pii_surrogates,
        "op9_bpe_round_trip": op9_bpe_round_trip,
        "op10_language_id": op10_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op4_setsketch_near_dedup": OP4_SQL, "op5_paragraph_dedup": OP5_SQL, "op6_embedding_near_dedup": OP6_SQL}
