import random
import re

import pytest

from quarry.llm import op2_near
from tests.llm import edge


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows, num, den):
    """{doc_id: (set size, component)} from all pairs."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    label = {d: d for d, _ in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and den * len(s & t) >= num * len(s | t):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {d: (len(s), root(d)) for d, s in sets}


def family(seed, n, size, swaps):
    """Near copies of one text, each with some of its words changed."""
    rng = random.Random(seed)
    words = edge.prose(seed, size, 5000).split()
    out = []
    for k in range(n):
        own = list(words)
        for _ in range(rng.randrange(swaps + 1)):
            own[rng.randrange(size)] = f"x{seed}_{k}_{rng.randrange(99)}"
        out.append(" ".join(own))
    return out


def check(spark, rows, num=85, small=64):
    got = op2_near.components(spark.createDataFrame(rows, "doc_id bigint, text string"), num, 100, small=small).collect()
    want = brute(rows, num, 100)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_families_against_all_pairs(spark):
    texts = [t for s in range(6) for t in family(s, 12, 120, 4)] + [edge.prose(90 + i, 80, 5000) for i in range(30)]
    random.Random(1).shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_large_nodes_branch_on(spark):
    """With a small node limit the trees go several levels down, and no link is lost."""
    shared = " ".join(f"p{i}" for i in range(60))
    texts = family(7, 60, 150, 5) + [shared + " " + edge.prose(200 + i, 40, 5000) for i in range(40)]
    check(spark, list(enumerate(texts)), small=2)


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edge.rows()]
    check(spark, [*dict.fromkeys(rows)], num=80)
    got = op2_near.components(edge.docs(spark))
    assert edge.count(got) == len(edge.rows())
    assert op2_near.components(edge.empty(spark)).collect() == []


def test_keep_first_keeps_columns(spark):
    docs = edge.docs(spark)
    kept = op2_near.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 6 in ids and 7 not in ids and 8 not in ids and 9 not in ids and ids.count(None) == 2


@pytest.mark.parametrize("num, changed", [(80, 22), (85, 16)])
def test_links_inside_a_large_unlinked_group(spark, num, changed):
    """A group that shares 166 of 200 shingles stays together for levels; pairs just over the threshold are linked in it."""
    rng, shared, texts = random.Random(3), [f"p{i}" for i in range(170)], []
    for k in range(100):
        own = [f"o{k}_{i}" for i in range(34)]
        texts += [" ".join(shared + own), " ".join(shared + own[:-changed] + [f"x{k}_{i}" for i in range(changed)])]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert sum(d != c for d, (_, c) in brute(rows, num, 100).items()) == 100  # the pairs, and no other link
    check(spark, rows, num=num, small=2)


def staged_rows(monkeypatch):
    """{name: rows of each table that op2 stages under it}, filled while it runs."""
    sizes, stage = {}, op2_near.stage

    def counted(df, name):
        out = stage(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(op2_near, "stage", counted)
    return sizes


def test_no_pairs_of_a_large_unlinked_group(spark, monkeypatch):
    """Of 120 texts that share 166 of 200 shingles, only pairs that may be links are written, not all 7,140."""
    sizes, shared = staged_rows(monkeypatch), [f"p{i}" for i in range(170)]
    texts = [" ".join(shared + [f"o{k}_{i}" for i in range(34)]) for k in range(120)]
    check(spark, list(enumerate(texts)), small=256)
    assert max(sizes["path-pairs"]) <= 8 * len(texts)


def test_large_nodes_take_few_rows_down(spark, monkeypatch):
    """Texts that share a tenth of their shingles leave their large nodes by pairs of tokens, some rows each."""
    sizes, shared = staged_rows(monkeypatch), [f"p{i}" for i in range(44)]
    texts = [" ".join(shared + [f"o{k}_{i}" for i in range(360)]) for k in range(40)]
    check(spark, list(enumerate(texts)), small=2)
    first, *_ = sizes["path-deeper"]
    assert first <= op2_near.pairs_for(0.9999995, 85, 100) * len(texts)
