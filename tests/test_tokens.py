"""Tokenizer, vocabulary, truncation/padding, packing invariants, loss masks."""

from pyspark.sql import functions as F

from quarry.operators import instructions as INS
from quarry.operators import tokens as TK
from quarry.plans.options import PackOptions


def _docs(spark):
    rows = [(1, "Ala ma kota, a kot ma Alę."), (2, "W 2024 roku: 3 koty!"), (3, "ala ala ala"), (4, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_token_regex(one_col):
    assert one_col(lambda c: TK.token_strings(c), ["Hello, world 123 ok!"]) == [["Hello", ",", "world", "123", "ok", "!"]]


def test_vocab_ids_and_unknowns(spark):
    docs = _docs(spark)
    vocab = TK.build_vocab(docs, "text", 3)
    v = {r.token: r.id for r in vocab.collect()}
    assert sorted(v.values()) == [4, 5, 6]
    assert v["ala"] == 4  # most frequent first
    ids = {r.doc_id: r.ids for r in TK.tokenize(docs, vocab).collect()}
    assert ids[3] == [4, 4, 4]
    assert ids[4] == []
    assert all(i == TK.UNK or i in v.values() for i in ids[2])


def test_truncate_pad_mask(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "ids array<int>")
    r = df.select(TK.truncate(F.col("ids"), 2).alias("t"), TK.pad_to(F.col("ids"), F.lit(5)).alias("p"),
                  TK.attention_mask(F.col("ids"), F.lit(5)).alias("m")).collect()[0]
    assert r.t == [5, 6] and r.p == [5, 6, 7, 0, 0] and r.m == [1, 1, 1, 0, 0]


def test_pack_conserves_tokens(spark):
    rows = [(i, list(range(10, 10 + (i * 7) % 23))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    total = sum(len(r[1]) + 1 for r in rows)
    for buckets in (1, 3):
        opts = PackOptions(seq_len=16, buckets=buckets, keep_partial=True)
        packed = TK.pack(df, opts).collect()
        assert sum(r.n_tokens for r in packed) == total
        partial = [r for r in packed if r.n_tokens < 16]
        assert len(partial) <= buckets
        full = TK.pack(df, PackOptions(seq_len=16, buckets=buckets, keep_partial=False)).collect()
        assert all(r.n_tokens == 16 for r in full)
        assert sum(r.n_tokens for r in full) + sum(r.n_tokens for r in partial) == total
        assert sum(r.tokens.count(TK.EOS) for r in packed) == len(rows)


def test_loss_mask(spark):
    df = spark.createDataFrame([(2, 3)], "a int, b int")
    r = df.select(INS.loss_mask(F.col("a"), F.col("b")).alias("m"),
                  INS.loss_mask(F.col("a"), F.col("b"), completion_only=False).alias("f")).collect()[0]
    assert r.m == [0, 0, 1, 1, 1] and r.f == [1, 1, 1, 1, 1]


def test_conversation_pairs(spark):
    conv = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"),
                                  (1, 3, "user", "q2"), (2, 0, "user", "q3")], "conv_id long, turn long, role string, text string")
    pairs = INS.format_instructions(INS.conversation_pairs(conv)).collect()
    assert [(p.prompt, p.response) for p in pairs] == [("q1", "a1")]
    assert pairs[0].text == "q1\nOdpowiedz: a1"


def _rows(spark, n, seed=3):
    import random
    rng = random.Random(seed)
    rows = [(f"r{i}", ids := [rng.randrange(4, 99) for _ in range(rng.randrange(40))], [rng.randrange(2) for _ in ids]) for i in range(n)]
    rows += [("none", None, None), ("empty", [], [])]
    return rows, spark.createDataFrame(rows, "id string, ids array<int>, mask array<int>").repartition(3)


def test_pack_masked_cuts_all_arrays_alike(spark):
    rows, df = _rows(spark, 60)
    opts = PackOptions(seq_len=16, buckets=2)
    chunks = sorted(TK.pack_masked(df, opts).collect(), key=lambda r: (r.bucket, r.chunk))
    docs, at = {}, {}
    for c in chunks:
        assert len(c.tokens) == len(c.loss_mask) == len(c.segment_ids) == len(c.positions) == c.n_tokens <= 16
        for k, (t, m, s, p) in enumerate(zip(c.tokens, c.loss_mask, c.segment_ids, c.positions)):
            new = k == 0 or s != c.segment_ids[k - 1]
            assert p == (0 if new else c.positions[k - 1] + 1) and s == (1 if k == 0 else c.segment_ids[k - 1] + new)
            at.setdefault(c.bucket, []).append((t, m))
            if k and new:
                assert c.tokens[k - 1] == TK.EOS
    for stream in at.values():  # the documents come back whole, each ended by a scored EOS
        doc = []
        for t, m in stream:
            doc.append((t, m))
            if t == TK.EOS:
                docs[tuple(doc)] = docs.get(tuple(doc), 0) + 1
                doc = []
        assert not doc
    want = {}
    for _, ids, mask in rows:
        key = tuple(zip([*(ids or []), TK.EOS], [*(mask or []), 1]))
        want[key] = want.get(key, 0) + 1
    assert docs == want
    full = TK.pack_masked(df, PackOptions(seq_len=16, buckets=2, keep_partial=False)).collect()
    assert all(c.n_tokens == 16 for c in full) and len(full) < len(chunks)


def test_pack_masked_rejects_another_length(spark):
    import pytest
    with pytest.raises(Exception, match="differ in length"):
        TK.pack_masked(spark.createDataFrame([("a", [5, 6], [1])], "id string, ids array<int>, mask array<int>")).collect()


def test_collate_pads_to_the_longest_of_a_batch(spark):
    rows, df = _rows(spark, 50)
    got = sorted(TK.collate(df, 4, "id", mask_col="mask").collect(), key=lambda r: (r.batch, r.row))
    held = {i: (ids or [], mask or []) for i, ids, mask in rows}
    order = sorted(held, key=lambda i: (len(held[i][0]), i))
    assert [r.id for r in got] == order and [r.batch * 4 + r.row for r in got] == list(range(len(order)))
    for r in got:
        ids, mask = held[r.id]
        width = max(len(held[i][0]) for i in order[r.batch * 4:r.batch * 4 + 4])
        gap = width - len(ids)
        assert r.padded_length == width and r.input_ids == ids + [TK.EOS] * gap and r.attention_mask == [1] * len(ids) + [0] * gap
        assert r.labels == [t if m else -100 for t, m in zip(ids, mask)] + [-100] * gap
    assert {r.input_ids[-1] for r in TK.collate(df, 4, "id", pad_id=0).collect() if 0 in r.attention_mask} == {0}
    assert TK.collate(df.limit(0), 4, "id").collect() == []


def test_token_lists_are_looked_up_in_slices():
    import pyarrow as pa

    lists = [["a"] * n for n in (3, 0, 4, 9, 1, 1, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array([["x"], *lists])], names=["k", "t"]).slice(1)
    parts = list(TK.list_slices(batch, "t", 5))
    assert [p.column("t").to_pylist() for p in parts] == [lists[:2], lists[2:3], lists[3:4], lists[4:]]
    assert sum((p.column("k").to_pylist() for p in parts), []) == list(range(1, 8))


def test_tokens_split_before(spark):
    """Texts split into tokens once give the vocabulary and the ids of the texts themselves."""
    docs = spark.createDataFrame([(1, "Ala ma kota, a kot 12 lat."), (2, ""), (3, None), (4, "kota ma Ala")], "doc_id int, text string")
    split = docs.select("doc_id", TK.token_strings(F.col("text")).alias("tokens"))
    vocab = TK.build_vocab(docs, "text", 5)
    assert sorted(vocab.collect()) == sorted(TK.build_vocab(split, "tokens", 5).collect())
    ids = sorted(map(tuple, TK.tokenize(docs, vocab, "text").collect()))
    assert ids == sorted(map(tuple, TK.tokenize(split, vocab, "tokens").collect()))
