import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(4000))
BASE = " ".join(f"b{i}" for i in range(60))

# Edge cases: nulls, empty and very long texts, ties, repeated rows and ids.
ROWS = [
    (1, BASE + "\nshared line here\n" + LONG, "en", "s", 1), (2, BASE + "\nshared line here\n" + LONG, "en", "s", 1),
    (3, None, "en", None, None), (4, "", None, "s", 0), (5, " \t\n ", "en", "s", 3), (None, BASE, "en", "s", 5),
    (None, BASE, "en", "s", 5), (6, "a b c", "de", "s", 5), (7, "A b  C", "de", "s", 5), (7, "A b  C", "de", "s", 5),
    (8, BASE.replace("b30 ", "x30 "), "en", "s", 5), (9, "one\none\ntwo two\n\n#$%", "fr", "t", 9),
    (10, "Released under the MIT Licence!\nCopyright 2020 Someone", "en", "s", 9), (11, "é" * 30 + " " + BASE.upper(), "en", "s", 9),
] + [(20 + i, f"Shared Line here \nown line {i}", "en", "s", 9) for i in range(12)]
ITEMS = [(1, " ".join(f"b{i}" for i in range(10, 40))), (2, "nothing of the kind is in there at all"), (3, None), (4, ""), (None, "a b c")]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """The edge cases with further columns whose names clash with internal ones."""
    from pyspark.sql import functions as F
    return (spark.createDataFrame(ROWS, DOC_SCHEMA)
            .withColumns({c: F.lit("x") for c in ("row_key", "tag", "hash", "kept", "positions", "m", "measures_", "N_words", "_part")}))


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture(scope="session")
def con(docs, items):
    c = duckdb.connect()
    import pandas as pd
    c.register("d_", pd.DataFrame(ROWS, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"}))
    c.register("i_", pd.DataFrame(ITEMS, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    c.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, lang::VARCHAR AS lang, source::VARCHAR AS source, n_chars::BIGINT AS n_chars FROM d_")
    c.execute("CREATE TABLE benchmark AS SELECT item_id::BIGINT AS item_id, text::VARCHAR AS text FROM i_")
    return c
