import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402
import pytest  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def plain_docs():
    """Documents of the smallest test table as (doc_id, text)."""
    return duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and repeated rows, ties, shared passages and one very long text."""
    passage = " ".join(f"word{i} of the passage" for i in range(60))
    long = " ".join(f"long{i % 977} text{i % 13}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, passage), (7, passage), (7, passage),
        (8, "Before " + passage + " after"), (9, "xx " + passage + "   yy"), (10, long), (11, "tail " + long[:200_000]),
        (None, passage), (None, "no id"), (12, "aaaa " * 300), (13, "a" * 5000), (14, "naïve café – 漢字 🙂 <|endoftext|> x"),
        (15, "  leading and   inner \r\n\r\n spaces  "), (16, "\x00 nul \x1f unit"), (17, passage.upper()),
    ]


@pytest.fixture
def docs_of(spark):
    """Make a documents table, with columns whose names clash with the operators' own."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
        if clash:
            from pyspark.sql import functions as F

            for name in ("doc_key", "key", "h", "kept", "runs", "hash", "digest_", "key_", "told", "fp", "u", "root", "row", "part"):
                df = df.withColumn(name, F.lit(7))
        return df

    return make
