import pytest

from sparlode.llm.common import ship

LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture
def docs(shipped):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def make(rows, parts=3):
        data = [(i, t, "x", 1, "row", -7, "n") for i, t in rows]
        return shipped.createDataFrame(data, "doc_id long, text string, keep_id string, n long, row string, id long, _gone string").repartition(parts)

    return make


def by_id(df, *columns, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v, key=str) for k, v in out.items()}
