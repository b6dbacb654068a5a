"""Data and fixtures that the tests of the training-data operators share."""

import pytest

SMALL = "/root/testdata/sf0.001"

#: What every operator on documents must take: nulls, empty and odd texts, ties, repeats.
EDGE_TEXTS = [None, "", " ", "\n", "word", "a b", "Tab\there", "  two  spaces  ", "x" * 5000, "żółw 漢字 😀 ok",
              "the same text twice", "the same text twice", "<|endoftext|> inside", "a\x00b", "lone ▁ mark▁"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge cases with a NULL id, a repeated row and columns whose names clash with the
    operators' own."""
    rows = [(i, t, "en" if i % 2 else None, "s", 7, 1, "x", 0.5) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "no id here", None, None, 0, 0, "y", 0.0), rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long, n_tokens long, ids string, score double")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def texts_of(df):
    """(doc_id, text with NULL as empty) of every row."""
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
