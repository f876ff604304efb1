from __future__ import annotations

import pytest

ODD = "doc_id bigint, text string, n_lines bigint, hits string, `a.b` string, row int, kept int, size int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like results."""
    long = "\n".join(f"line number {i} of a very long text, word{i}" for i in range(20_000))
    line = "This line stands in several documents\n"
    rows = [
        (1, None, 5, "x", "p", 1, 1, 1),
        (2, "", None, None, None, None, None, None),
        (3, line + "only here, in document three", 1, "", "q", 2, 0, 3),
        (4, "\t" + line.upper() + "short", 2, "", "q", 2, 0, 3),
        (4, "\t" + line.upper() + "short", 2, "", "q", 2, 0, 3),
        (None, line + "a text without id", 3, "h", None, 7, 7, 7),
        (6, long, 4, "h", "r", 0, 0, 0),
        (7, long + " and its end", 4, "h", "r", 0, 0, 0),
        (8, " \t\n\x0b", 9, "h", "r", 9, 9, 9),
        (9, "é" * 12 + "\n" + "é" * 12, 9, "h", "r", 9, 9, 9),
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="session")
def stored(tmp_path_factory):
    """Writes a frame and reads it again, as operators that read twice want it."""
    def run(df, name):
        path = str(tmp_path_factory.mktemp("stored") / name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return run
