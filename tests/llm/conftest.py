import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (ids count up), or from (id, text) pairs; with columns of clashing names."""

    def build(rows, extra=True):
        rows = [(r if isinstance(r, tuple) else (i, r)) for i, r in enumerate(rows)]
        full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        names = ("bits", "row", "start", "ids", "key", "shard", "gone_id", "node", "score", "path", "gram", "length")
        return df.selectExpr("*", *[f"'x' AS `{n}`" for n in names]) if extra else df

    return build


@pytest.fixture(scope="session")
def documents(spark, small_sf):
    return spark.read.parquet(f"{small_sf}/documents.parquet")


ODD_TEXTS = [None, "", " ", "\n\t ", "a", "word " * 30_000, "x" * 50_000, "é漢🙂 a b", "same text here", "same text here", "\x00 nul"]
