import os

import pytest

TYPED = {"documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
         "labels": "doc_id bigint, quality int, toxic int", "pages": "page_id bigint, url string, html string",
         "benchmark": "item_id bigint, text string", "embeddings": "vec_id bigint, embedding array<float>, label int"}


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) rows."""
    return lambda rows: spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], TYPED["documents"])


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables, given as lists of rows, to a folder and returns it."""
    def write(**tables):
        for name, rows in tables.items():
            spark.createDataFrame(rows, TYPED[name]).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
        return str(tmp_path)
    return write
