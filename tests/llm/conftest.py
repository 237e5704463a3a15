import hashlib

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def table(spark):
    """Documents of the given texts, numbered from ``first``."""

    def make(texts, first=0, langs=None):
        rows = [(first + i, t, langs[i] if langs else "en", "src0", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture(scope="session")
def folder(tmp_path_factory):
    """Writes tables as the query layout has them and gives the folder."""

    def make(**tables):
        base = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{base}/{name}.parquet")
        return str(base)

    return make


@pytest.fixture(scope="session")
def sha():
    return lambda value: hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()
