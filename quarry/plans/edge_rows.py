"""Edge-case rows unioned into the ``documents`` table by the checked queries.

The fixture corpus never holds null/empty text, NFC-changing text, control
characters or over-long text, so the queries add these rows (in both engines)
on top of the whole table. Each row is given as a Python value for Spark and
an equivalent DuckDB SQL expression for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BASE_ID = 1_000_000_000

# Fixed values: (id offset, python text, duckdb expression, lang, source).
EDGE_ROWS = [
    (1, None, "NULL", "en", "edge"),
    (2, "", "''", "en", "edge"),
    (3, " \t\r\n\u3000 ", "' ' || chr(9) || chr(13) || chr(10) || chr(12288) || ' '", "en", "edge"),
    (4, "a\u0301" * 150, "repeat('a' || chr(769), 150)", "en", "edge"),
    (5, "x" * 200_001, "repeat('x', 200001)", "en", "edge"),
    (6, "x" * 200_000, "repeat('x', 200000)", "en", "edge"),
    (7, "y" * 199, "repeat('y', 199)", "en", "edge"),
    (8, "y" * 200, "repeat('y', 200)", "en", "edge"),
    (9, "Ala\x01ma\x7fkota\r\n " * 30, "repeat('Ala' || chr(1) || 'ma' || chr(127) || 'kota' || chr(13) || chr(10) || ' ', 30)", "en", "edge"),
    (10, "Zaz\u0307o\u0301\u0142c\u0301 ge\u0328s\u0301la\u0300 ja\u0301z\u0301n\u0301 " * 20,
     "repeat('Zaz' || chr(775) || 'o' || chr(769) || chr(322) || 'c' || chr(769) || ' ge' || chr(808) || 's' || chr(769) || 'la' || chr(768) || ' ja' || chr(769) || 'z' || chr(769) || 'n' || chr(769) || ' ', 20)",
     "pl", "edge"),
    (11, "\u00a0z\u2003" * 100, "repeat(chr(160) || 'z' || chr(8195), 100)", "en", "edge"),
    (12, "Ala ma kota. " * 20, "repeat('Ala ma kota. ', 20)", "pl", "edge"),
    (13, "Ala  ma\tkota. " * 20, "repeat('Ala  ma' || chr(9) || 'kota. ', 20)", "pl", "edge"),
]

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
])


def edge_df(spark: SparkSession) -> DataFrame:
    rows = [(BASE_ID + i, py, lang, src) for i, py, _sql, lang, src in EDGE_ROWS]
    return spark.createDataFrame(rows, SCHEMA)


def edge_sql() -> str:
    """DuckDB SELECT producing the same rows (doc_id, text, lang, source)."""
    parts = [
        f"SELECT CAST({BASE_ID + i} AS BIGINT) AS doc_id, CAST({sql} AS VARCHAR) AS text, '{lang}' AS lang, '{src}' AS source"
        for i, _py, sql, lang, src in EDGE_ROWS
    ]
    return " UNION ALL ".join(parts)
