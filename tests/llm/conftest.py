import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text[, lang[, source]])."""
    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)
    return make


@pytest.fixture
def folder(spark, tmp_path):
    """A folder of tables as the queries read it, from frames by name."""
    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
