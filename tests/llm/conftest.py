import pytest
from pyspark.sql import types as T

from heliotab.llm.registry import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """docs(rows): a documents table; rows are (doc_id, text) or (doc_id, text, lang)."""
    prepare(spark)

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] else 0) for r in rows]
        return spark.createDataFrame(full, T.StructType.fromDDL(DOCS)).repartition(parts)

    return make


@pytest.fixture
def sf(spark, tmp_path):
    """sf(table=DataFrame, ...): a folder of tables, as queries read them."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
