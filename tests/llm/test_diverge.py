import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from quarry.llm import op12_diverge
from tests.llm import edge

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "lang string, source string, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least, top=50):
    docs, held, counts = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = terms(text)
        counts[lang or "", source or ""].update(found)
        held[lang or ""].update(set(found))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in held[lang].items() if n >= least]
        v = len(kept)
        groups = {s: c for (l, s), c in counts.items() if l == lang}
        whole = sum((Counter({t: c[t] for t in kept}) for c in groups.values()), Counter())

        def price(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * v) for t in kept}

        p, q = {s: price(c) for s, c in groups.items()}, price(whole)
        for s, c in groups.items():
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def check(spark, rows, least, **options):
    got = op12_diverge.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), least_docs=least, **options).collect()
    found = {tuple(r) for r in got}
    assert len(found) == len(got)
    assert found == brute(rows, least, options.get("top", 50))


def sample(seed, n, sources, vocabulary):
    rng = random.Random(seed)
    return [(rng.choice(["en", "en", "de"]), f"s{int(rng.random() ** 2 * sources)}",
             " ".join(f"{'wW'[rng.random() < .1]}{chr(97 + i % 26)}{'x' * (i // 26)}" for i in (int(rng.random() ** 3 * vocabulary) for _ in range(30))))
            for _ in range(n)]


def test_against_all_cells(spark):
    check(spark, sample(1, 120, 9, 90), 3)


def test_many_blocks(spark, monkeypatch):
    """Groups and terms cut into many small blocks give the same sums."""
    monkeypatch.setattr(op12_diverge, "ROWS", 4)
    monkeypatch.setattr(op12_diverge, "COLUMNS", 16)
    check(spark, sample(2, 150, 14, 120), 2, top=3)


def test_joint_traversal():
    rng = np.random.default_rng(5)
    for width, a, b in ((1, 1, 3), (64, 8, 8), (200, 21, 9), (1000, 3, 40), (4096, 17, 1)):
        blocks, dense = [], []
        for n, first in ((a, 0), (b, 100)):
            p = np.repeat(rng.integers(1, 99, (n, 1)), width, axis=1)
            marks = [(first + g, -1, int(p[g, 0])) for g in range(n)]
            cells = [(first + int(g), int(c), int(rng.integers(100, 999)))
                     for g, c in set(zip(rng.integers(0, n, 30).tolist(), (width * rng.random(30) ** 4).astype(int).tolist()))]
            for g, c, v in cells:
                p[g - first, c] = v
            rows = marks + cells
            rng.shuffle(rows)
            blocks.append(op12_diverge._Block(pa.table({k: [int(r[i]) for r in rows] for i, k in enumerate(("row", "col", "p"))}), width))
            dense.append(p)
        want = np.abs(dense[0][:, None, :] - dense[1][None, :, :]).sum(axis=2)
        assert (op12_diverge._distances(*blocks, width) == want).all()


def test_terms_over_piece_borders(monkeypatch):
    text = "Ab ż😀-x " * 50 + "y" * 40 + " z1z_Z"
    want = Counter(t.encode() for t in terms(text))
    for piece in (1, 2, 7, 1000):
        monkeypatch.setattr(op12_diverge, "PIECE", piece)
        assert op12_diverge.count_terms(text.encode()) == want


def test_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    n = 10 ** 15
    got = spark.range(1).select(op12_diverge.smoothed(F.lit(n), F.lit(3 * n + 1), F.lit(7)).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (n + 5) // (3 * n + 1 + 35)


def test_edge_rows(spark):
    rows = [(r[2], r[3], r[1]) for r in edge.rows()]
    check(spark, rows, 1)
    check(spark, rows, 99)  # no term is kept: pairs at 0
    check(spark, [("en", "only", "a b"), (None, None, None), ("", "x", "")], 1)
    clash = edge.docs(spark).selectExpr("*", "'t' AS term", "1 AS row", "'p' AS part")
    assert edge.count(op12_diverge.audit(clash, least_docs=1)) == len(brute(rows, 1))
    assert op12_diverge.audit(edge.empty(spark)).collect() == []
