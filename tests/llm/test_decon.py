import random
import re

from quarry.llm import op8_decon as D
from tests.llm import edge


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def check(spark, docs, items, **kw):
    got = D.search(spark.createDataFrame(docs, "doc_id bigint, text string, item_id string"),
                   spark.createDataFrame(items, "item_id bigint, text string, doc_id string"), **kw).collect()
    want = {}
    for i, t in sorted((x[:2] for x in items if x[0] is not None), reverse=True):
        if shingles(t):
            want[frozenset(shingles(t))] = i
    hits = {(d, i): (len(s), len(s & shingles(t))) for d, t, _ in docs if d is not None
            for s, i in want.items() if 100 * len(s & shingles(t)) >= 80 * len(s)}
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == hits and len(got) == len(hits)
    return hits


def test_against_all_pairs(spark):
    rng = random.Random(2)
    items = [(i, edge.prose(500 + i, rng.choice([5, 8, 20, 33, 60]), 3000), "x") for i in range(25)]
    items += [(90, items[3][1], "x"), (91, "two words", "x"), (92, "", "x"), (93, None, "x"), (None, items[4][1], "x")]
    docs = []
    for d in range(60):
        w = edge.prose(d, rng.choice([30, 300, 3000]), 3000).split()
        part = rng.choice(items[:25])[1].split()
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = "swapped"
        at = rng.randrange(len(w))
        docs.append((d, " ".join(w[:at] + part + w[at:]).upper() if d % 5 == 0 else " ".join(w[:at] + part + w[at:]), "y"))
    docs += [(100, "Two words", "y"), (101, None, "y"), (102, "", "y"), (None, items[0][1], "y"), docs[0]]
    hits = check(spark, docs, items)
    assert len(hits) > 10
    check(spark, docs, items, sketch_rows=0)


def test_edge_rows(spark):
    docs, bench = edge.docs(spark), spark.createDataFrame([(1, edge.prose(1, 60), "z")], "item_id bigint, text string, text2 string")
    assert {r.doc_id for r in D.search(docs, bench).collect()} >= {6, 7, 8}
    kept = D.keep_clean(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {None, 0, 1, 10}
    assert D.search(edge.empty(spark), bench).collect() == []
    assert edge.count(D.keep_clean(docs, bench.limit(0))) == len(edge.rows())
