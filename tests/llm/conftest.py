import pytest

TEXT = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows -> a table with clashing extra columns."""

    def make(rows):
        wide = [(i, t, "a", 1, 2) for i, t in rows]
        return spark.createDataFrame(wide, "doc_id long, text string, kept string, n_words int, node int").repartition(3)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def sample():
    import duckdb

    return duckdb.connect().execute("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY 1").fetchall()


EDGES = [(None, None), (None, "a b c"), (900001, None), (900002, ""), (900003, " \n\t "), (900004, "x" * 50_000), (900005, "word " * 30_000), (900006, "tie"), (900007, "tie"), (900007, "tie")]


@pytest.fixture(scope="session")
def edges():
    return EDGES
