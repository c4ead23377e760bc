import pytest

SMALL = "/root/testdata/sf0.001"
#: Columns whose names clash with what operators use inside, on every fixture.
CLASH = {"id_": 1, "text_": "x", "count": 2, "rank": 3, "size": 4, "tag_": 5, "v": 6, "a": 7, "label": 8}


@pytest.fixture(scope="session")
def documents(spark):
    """A ``documents`` table of given texts, with clashing extra columns."""

    def made(rows):
        rows = [(*r, None)[:3] if len(r) == 2 else r for r in rows]
        schema = "doc_id long, text string, source string, lang string, n_chars long, id_ int, text_ string, count int, rank int, size int, tag_ int, v int, a int, label int"
        return spark.createDataFrame([(i, t, s, "en", len(t or ""), *CLASH.values()) for i, t, s in rows], schema)

    return made


@pytest.fixture(scope="session")
def small_documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
