"""Connected components on shapes that are hard for label propagation."""

import random

from quarry.operators.components import connected_components


def labels(spark, edges):
    df = spark.createDataFrame(edges, "id_a long, id_b long")
    return {r.node: r.label for r in connected_components(df).collect()}


def test_shuffled_chain(spark):
    ids = list(range(1000))
    random.Random(1).shuffle(ids)
    assert labels(spark, list(zip(ids, ids[1:]))) == {i: 0 for i in range(1000)}


def test_hub_with_many_leaves(spark):
    got = labels(spark, [(500, i) for i in range(20_000)])
    assert len(got) == 20_000 and set(got.values()) == {0}


def test_loops_repeats_and_nulls(spark):
    assert labels(spark, [(3, 3), (5, 4), (4, 5), (5, 4), (None, 1), (7, 9), (9, 8)]) == {4: 4, 5: 4, 7: 7, 8: 7, 9: 7}
    assert labels(spark, [(1, None)]) == {}
