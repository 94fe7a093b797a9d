"""Rows that every operator has to take: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, rep string, _w string, label string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 60)
    near = base.replace(base.split()[30], "changed", 1)
    texts = [None, "", " \t\n\r\x0b\x0c ", "one", "One", "two words", base, base, base.upper(), near, prose(2, 5000),
             "line a b c d e f g\nline a b c d e f g\n\nother", "żółć 😀 e\u0301 \u00a0 x" * 3, "a" * 50_000, "!!! ??? ...", "1 2 3"]
    out = [(i, t, [None, "en", "fr"][i % 3], [None, "s", ""][i % 3], None) for i, t in enumerate(texts)]
    out += [out[6], out[6], (None, base, "en", "s", 1), (None, None, None, None, None)]  # repeated rows, null ids
    return [(*r, "x", "y", "z", "v") for r in out]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


#: Names that operators use for columns of their own for a while.
TAKEN = ["_judged", "_row", "_found", "_h", "_s", "_b", "_mix", "_cell", "_weight", "_hits", "_new", "_pred", "_known", "_PRED_", "_n", "_f"]


def taken(spark):
    """``docs`` with a column of each of the names in ``TAKEN``."""
    return docs(spark).select("*", *[F.lit(f"own {n}").alias(n) for n in TAKEN])


def keeps_taken(before, after) -> bool:
    """Whether ``after`` still has every column of ``before`` and the values of ``taken`` in them."""
    own = [F.count_if(F.col(n) != f"own {n}").alias(n) for n in TAKEN]
    return after.columns[:len(before.columns)] == before.columns and set(after.select(own).first()) == {0}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def count(df) -> int:
    return df.select(F.count(F.lit(1))).first()[0]
