"""Small frames and comparisons for the text operators' tests."""

import os

import duckdb

SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "two words",
    "The quick brown fox jumps over the lazy dog",
    "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG",
    "naïve café   東京 😀 é",
    "x" * 5000,
    "a b " * 3000,
    "line one\nline one\r\nline two\x0bthree\x0cfour",
]


def documents(spark, rows=None, more=""):
    """(doc_id, text, lang, source, n_chars), with columns named like working ones if asked for."""
    rows = [(i, t, "en", f"src{i % 3}" if i % 4 else None) for i, t in enumerate(ODD_TEXTS)] if rows is None else rows
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.selectExpr("*", "cast(length(text) as long) as n_chars")
    return frame.selectExpr("*", *[f"'{c}' as `{c}`" for c in more.split()])


def duck(folder):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        name = file.removesuffix(".parquet")
        path = f"{folder}/{file}" + ("/*.parquet" if os.path.isdir(f"{folder}/{file}") else "")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def same_rows(df, relation_sql, connection):
    names = sorted(df.columns)
    listed = ", ".join(f'"{c}"' for c in names)
    expected = connection.execute(f"SELECT {listed} FROM ({relation_sql})").fetchall()
    found = [tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(found, key=key) == sorted(expected, key=key)
