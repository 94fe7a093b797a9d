import random
import re

import numpy as np
import pytest

from quarry.llm import op13_parity, pairs
from tests.llm import edge


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 3:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)}


def brute(rows, num, den):
    """(doc_id, set size, component) of every row, from all pairs; rows of one doc_id are tied."""
    sets = [(d, shingles(t)) for d, t in rows]
    label = {d: d for d, _ in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and None not in (a, b) and a != b and den * len(s & t) >= num * len(s | t):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


def check(spark, rows, num=90, **options):
    got = op13_parity.components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), num, 100, **options).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, num, 100)


def family(seed, n, size, swaps):
    rng = random.Random(seed)
    words = edge.prose(seed, size, 5000).split()
    out = []
    for k in range(n):
        own = list(words)
        for _ in range(rng.randrange(swaps + 1)):
            own[rng.randrange(size)] = f"x{seed}_{k}_{rng.randrange(99)}"
        out.append(" ".join(own))
    return out


def test_families_against_all_pairs(spark):
    """Sizes from a few words to hundreds, with pairs on either side of the threshold."""
    texts = [t for s, size in enumerate((12, 25, 40, 70, 130, 300, 700)) for t in family(s, 14, size, size // 25 + 1)]
    texts += [edge.prose(90 + i, 80, 5000) for i in range(30)]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    assert len({c for _, _, c in brute(rows, 90, 100)}) < len(rows) - 20
    check(spark, rows)


@pytest.mark.parametrize("num", [50, 80])
def test_other_thresholds(spark, num):
    texts = [t for s, size in enumerate((9, 20, 60, 200)) for t in family(s, 16, size, size // 6 + 1)]
    check(spark, list(enumerate(texts)), num)


def test_large_groups_without_links(spark):
    """Documents that share most shingles but no link, with near pairs among them: large keys, compared in chunks."""
    rng, shared, texts = random.Random(3), [f"p{i}" for i in range(160)], []
    for k in range(60):
        own = [f"o{k}_{i}" for i in range(30)]
        texts += [" ".join(shared + own), " ".join(shared + own[:-12] + [f"x{k}_{i}" for i in range(12)])]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    links = sum(d != c for d, _, c in brute(rows, 85, 100))
    assert links == 60
    check(spark, rows, 85, small=4, chunk=16)
    check(spark, rows, 85)


def test_linked_sets_share_a_key():
    """Sets that differ in as many shingles as a link allows always meet, in every band."""
    rng = np.random.default_rng(11)
    met = 0
    for n in [*range(9, 130), 200, 451, 1000, 3000]:
        for _ in range(6):
            most = op13_parity.differences(n, 90, 100)
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            gone = int(rng.integers(0, most // 2 + 1))
            more = int(rng.integers(0, most - gone + 1)) if not gone else gone
            b = np.concatenate([a[gone:], rng.integers(0, 2**63, more, dtype=np.uint64)])
            if 190 * (gone + more) > 10 * (len(a) + len(b)):
                continue
            ka, kb = ({int(k) for band in op13_parity.bands_of(len(s), 90, 100) for k in op13_parity.band_keys(s, band, 90, 100)} for s in (a, b))
            assert ka & kb
            assert int(np.bitwise_count(pairs.sketch(a) ^ pairs.sketch(b)).sum()) <= gone + more
            met += 1
    assert met > 500


def test_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edge.rows()] + [(7, "quite another text of its own"), (50, "quite another text of its own"), (50, None)]
    check(spark, rows, 80)
    got = op13_parity.components(edge.docs(spark).selectExpr("*", "1 AS row", "2 AS key", "3 AS n", "4 AS bits"))
    assert edge.count(got) == len(edge.rows())
    assert op13_parity.components(edge.empty(spark)).collect() == []
