import pytest

# names that clash with what operators use inside, and a column they do not know
EXTRA = {"row_key": "x", "id": 7, "words": "w", "row": None}


@pytest.fixture
def texts(spark):
    """Documents with null, empty, blank, very long, tied and repeated rows, and columns with clashing names."""
    def make(rows, extra=True):
        from pyspark.sql import functions as F
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        return df.withColumns({k: F.lit(v) if v is not None else F.lit(None).cast("string") for k, v in EXTRA.items()}) if extra else df
    return make


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    """The documents of the smallest tables, as (doc_id, text)."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
