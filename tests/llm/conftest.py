import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASH = ", size int, mix string, row string, digest string, n int, cell int, key string, text_crc32 string, shard int, cls int"


@pytest.fixture
def frame(spark):
    """Rows as a documents table: (doc_id, text) or longer tuples, with clashing extra columns."""

    def make(rows, clash=True):
        full = [tuple(r) + (None,) * (5 - len(r)) + ((1, "m", "r", "d", 2, 3, "k", "c", 4, 5) if clash else ()) for r in rows]
        return spark.createDataFrame(full, DOCS + (CLASH if clash else ""))

    return make


@pytest.fixture
def stored(spark, tmp_path):
    """A frame as a Parquet table: (path, frame read from it)."""

    def put(df, name="documents"):
        path = str(tmp_path / f"{name}.parquet")
        df.write.mode("overwrite").parquet(path)
        return path, spark.read.parquet(path)

    return put
