import os

import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
EDGE_TEXTS = [None, "", " \n\t ", "one", "a b c", "the same text twice over here", "the same text twice over here",
              "ü\u0085  x\x00y", "word " * 3000, "x" * 5000, "é中\U0001f600" * 50, "line\n\nline\nline\n"]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 2}", i * 10, "k") for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id at all", "s1", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size bigint, label string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string, lang string, n_chars bigint")


@pytest.fixture(scope="session")
def sf_documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
