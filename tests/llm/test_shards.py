import zlib

from quarry.llm import op6_shards as S
from tests.llm import edge


def check(rows, texts, shards):
    """Shards by the definition, in the order (doc_id, crc, size) with nulls first."""
    size = {}
    order = sorted(((d is not None, d or 0, t is not None, zlib.crc32(t.encode()) if t is not None else 0,
                     len((t or "").encode()) + 16) for d, t in texts))
    total, run, want = sum(o[4] for o in order), 0, []
    for o in order:
        run += o[4]
        want.append((o[1] if o[0] else None, o[4], o[3] if o[2] else None, min(shards - 1, (2 * run - o[4]) * shards // (2 * total))))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard) for r in rows), key=key) == sorted(want, key=key)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


def test_edge_rows(spark):
    rows = edge.rows()
    got = S.assign(edge.docs(spark), shards=4).collect()
    check(got, [(r[0], r[1]) for r in rows], 4)
    assert S.assign(edge.empty(spark)).collect() == []


def test_balance_with_a_hot_text(spark):
    texts = [(i, "copy of one text" if i % 3 else edge.prose(i, 20)) for i in range(900)]
    got = S.assign(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(7)).collect()
    check(got, texts, 40)
    load = {}
    for r in got:
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert len(load) == 40 and max(load.values()) - min(load.values()) <= 2 * max(r.size for r in got)


def test_slot_is_a_long(spark):
    assert dict(S.assign(edge.docs(spark)).dtypes)["slot"] == "bigint"
