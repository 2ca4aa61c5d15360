import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__))]

SF = "/root/testdata/sf0.001"
#: Columns of the documents, and ones that clash with names the operators make.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", score double, n_words long, kept string, hash string, doc string, _text string, terms int, row int"


@pytest.fixture
def documents(spark):
    """A table of documents out of texts by id; repeated ids and nulls are allowed."""

    def make(rows, clashing=True):
        rows = [(doc, text, *(lang or ["en"])) for doc, text, *lang in rows]
        extra = (1.0, 2, "k", "h", "d", "t", 3, 4) if clashing else ()
        schema = DOCUMENTS + (CLASHING if clashing else "")
        full = [(doc, text, lang, "src", len(text or ""), *extra) for doc, text, lang in rows]
        return spark.createDataFrame(full, schema)

    return make


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
