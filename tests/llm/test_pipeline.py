import zlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sparlode.llm.common import Scratch, read_table, tokenizer_file
from sparlode.llm.pii import Replacer, settled, surrogate_key
from sparlode.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def stages(shipped, sf_dir):
    """Each stage's input and output."""
    docs, scratch, out = read_table(shipped, sf_dir, "documents"), Scratch(shipped, "test"), []
    for name, stage in corpus_pipeline.STAGES:
        new = scratch.put(stage(shipped, docs, sf_dir), name)
        out.append((name, docs, new))
        docs = new
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_toxicity_keeps_clean_documents(shipped, stages, sf_dir):
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    clean = {r.doc_id for r in read_table(shipped, sf_dir, "labels").where("toxic = 0").collect()}
    assert kept <= {r.doc_id for r in before.select("doc_id").collect()}
    assert len(clean & kept) >= 0.95 * len(clean)


def test_exact(stages):
    _, before, after = stages[1]
    want = {}
    for r in before.collect():
        want[r.text] = min(want.get(r.text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(want.values())


def test_near(stages):
    from .test_near_dedup import brute

    _, before, after = stages[2]
    found = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, v in found.items() if v[0][2])


def test_pii(shipped, stages):
    _, before, after = stages[3]
    key = surrogate_key(shipped)
    tool = Replacer(key, settled(before, key))
    new = {r.doc_id: tool.replace(r.text)[0] for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == new
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_packing(stages):
    _, before, after = stages[4]
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in before.collect()}
    for r in after.collect():
        part = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) and r.doc_tokens == len(want[r.doc_id])


def test_run_and_registry(shipped, sf_dir, stages):
    assert corpus_pipeline.run(shipped, sf_dir).count() == stages[-1][2].count()
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 11))
    assert set(oracle_sql()) <= set(queries())


EDGES = [(None, None), (None, "lost words"), (None, "lost words"), (1, None), (2, ""), (3, "some text"), (3, "some text"), (4, "some text"), (5, "mail me at jo@example.org")]
LEFT = {"toxicity": 9, "exact_dedup": 4, "near_dedup": 8, "pii": 9}


def edge_rows(spark, rows):
    """Documents with columns named like those the stages use inside."""
    kind = "doc_id long, text string, lang string, id long, n long, _gone long, _i string, row long, kept boolean, n_chars long"
    return spark.createDataFrame([(i, t, "en", 1, 2, i, "x", 3, False, len(t or "")) for i, t in rows], kind).repartition(3)


@pytest.mark.parametrize("name", [s[0] for s in corpus_pipeline.STAGES])
def test_stage_edges(shipped, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = edge_rows(shipped, EDGES)
    out = stage(shipped, docs, sf_dir)
    if name == "packing":
        assert sum(r.length == 1 and r.doc_tokens == 1 for r in out.collect()) == 3
    else:
        assert out.columns == docs.columns and out.count() == LEFT[name]
    assert stage(shipped, edge_rows(shipped, []), sf_dir).count() == 0
    if name == "exact_dedup":
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, None), (3, "some text"), (5, EDGES[-1][1]), (None, "lost words")], key=str)
    if name == "pii":
        new = [r for r in out.collect() if r.doc_id == 5][0]
        assert new.text != EDGES[-1][1] and new.n_chars == len(new.text)


def test_key_setting(shipped):
    drawn = surrogate_key(shipped)
    assert len(drawn) == 32 and drawn == surrogate_key(shipped)
    shipped.conf.set("spark.sparlode.surrogate.key", "a key for this test only")
    assert surrogate_key(shipped) == b"a key for this test only"
    shipped.conf.set("spark.sparlode.surrogate.key", "short")
    with pytest.raises(ValueError):
        surrogate_key(shipped)
    shipped.conf.unset("spark.sparlode.surrogate.key")
