"""Split / shuffle / shard / mix / sample invariants."""

from pyspark.sql import functions as F

from quarry.operators import sampling as SM


def _df(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.sha1(F.col("id").cast("string").cast("binary")).alias("doc_hash"))


def test_split_ratio_edges(spark):
    df = _df(spark)
    assert SM.split_train_val(df, val_ratio=0.0).where("split = 'val'").count() == 0
    assert SM.split_train_val(df, val_ratio=1.0).where("split = 'train'").count() == 0
    n_val = SM.split_train_val(df, val_ratio=0.05).where("split = 'val'").count()
    assert 20 < n_val < 90


def test_global_rank_is_dense_and_matches_sort(spark):
    df = SM.split_train_val(_df(spark), val_ratio=0.3)
    ranked = SM.shuffle_rank(df, "doc_hash", 7, ["split"]).collect()
    for split in ("train", "val"):
        rows = [r for r in ranked if r.split == split]
        assert sorted(r["rank"] for r in rows) == list(range(len(rows)))
        import hashlib
        order = sorted(rows, key=lambda r: (hashlib.sha1(f"7:{r.doc_hash}".encode()).hexdigest(), r.doc_hash))
        assert [r["rank"] for r in order] == list(range(len(rows)))


def test_shards_full_except_last(spark):
    for size in (7, 100, 1000, 5000):
        df = SM.assign_shards(SM.split_train_val(_df(spark), val_ratio=0.1), "doc_hash", size)
        counts = {}
        for r in df.groupBy("split", "shard").count().collect():
            counts.setdefault(r.split, {})[r.shard] = r["count"]
        for split, c in counts.items():
            last = max(c)
            assert sorted(c) == list(range(last + 1))
            assert all(c[s] == size for s in c if s != last) and 0 < c[last] <= size


def test_prefix_sum(spark):
    df = _df(spark, 200).withColumn("n", (F.col("doc_id") % 5) + 1)
    out = SM.global_rank(df.withColumn("h", SM.seeded_hash(1, F.col("doc_id"))), "h", "doc_id", out="off",
                         value_col="n").orderBy("off").collect()
    run = 0
    for r in out:
        assert r.off == run
        run += r.n


def test_mix_ratio_cap(spark):
    text = spark.range(950).select(F.concat(F.lit("d"), F.col("id")).alias("id"), F.lit("text").alias("kind"))
    inst = spark.range(500).select(F.concat(F.lit("i"), F.col("id")).alias("id"), F.lit("instruction").alias("kind"))
    mixed = SM.mix_instructions(text, inst, 0.05)
    n_inst = mixed.where("kind = 'instruction'").count()
    assert n_inst == 50  # floor(0.05 / 0.95 * 950)
    assert n_inst / mixed.count() <= 0.05
    assert SM.mix_instructions(text, inst, 0.0).where("kind = 'instruction'").count() == 0


def test_sample_fixed(spark):
    s = SM.sample_fixed(_df(spark), "doc_hash", 50)
    assert s.count() == 50
    assert sorted(r.doc_id for r in s.collect()) == sorted(r.doc_id for r in SM.sample_fixed(_df(spark).repartition(3), "doc_hash", 50).collect())


def test_order_rank_matches_sort(spark):
    import random
    rng = random.Random(1)
    rows = [(rng.randrange(5), i, "ab"[rng.random() < 0.1]) for i in range(300)]
    df = spark.createDataFrame(rows, "n int, id int, part string").repartition(6)
    got = {(r.n, r.id): r["rank"] for r in SM.order_rank(df, ["n", "id"], ["part"]).collect()}
    want = {}
    for part in "ab":
        want |= {(n, i): k for k, (n, i) in enumerate(sorted((n, i) for n, i, p in rows if p == part))}
    assert got == want
    shards = SM.assign_shards_in_order(df, ["n", "id"], 20, "part")
    assert shards.count() == 300 and shards.groupBy("part", "shard").count().where("count > 20").count() == 0
