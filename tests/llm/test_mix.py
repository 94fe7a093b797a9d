import pytest
from pyspark.sql import functions as F

from quarry.llm import op3_mix
from tests.llm import edge


def test_marginals_are_met(spark):
    cells = [("s%d" % i, "l%d" % j, "t%d" % k, 100 * (1 + i) * (1 + j) + 7 * k) for i in range(3) for j in range(2) for k in range(2)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens bigint")
    total = sum(c[3] for c in cells)
    want = {"source": {f"s{i}": total / 3 for i in range(3)}, "lang": {f"l{i}": total / 2 for i in range(2)}}
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in want.items()}
    out = op3_mix.rake(df, targets | {"topic": op3_mix.tempered(df, "topic")}, most=10.0)
    for d, v in want.items():
        got = {r[0]: r[1] for r in out.groupBy(d).agg(F.sum(F.col("tokens") * F.col("weight"))).collect()}
        assert got == pytest.approx(v, rel=1e-3)


def test_edge_rows(spark):
    docs = edge.docs(spark)
    got = op3_mix.sample(docs, rounds=2).collect()
    assert len(got) == len(edge.rows())
    assert all(0 <= r.prob <= 1 for r in got)
    kept = op3_mix.keep_sampled(docs, rounds=2)
    assert kept.columns == docs.columns and edge.count(kept) == sum(r.kept for r in got)
    assert op3_mix.sample(edge.empty(spark), rounds=1).collect() == []
