import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import op10_lang as G
from tests.llm import edge

SYLLABLES = {"aa": "ba ko ri tu", "bb": "shen gro plit quar", "cc": "żół ćmi łos ąda"}


def sentence(lang, seed, n=12):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(3)) for _ in range(n))


def corpus(spark):
    rows = [(i, sentence(l, i * 3 + k), l) for i in range(120) for k, l in enumerate(SYLLABLES)]
    return spark.createDataFrame([(j, t, l) for j, (_, t, l) in enumerate(rows)], "doc_id bigint, text string, lang string")


def grams(text):
    """The definition: 4-grams over letters and single blanks."""
    s = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    s = " " + " ".join(s.split()) + " "
    return [] if not s.strip() else [s[i:i + 4] for i in range(len(s) - 3)] or [s.ljust(4)]


def test_grams_by_definition(monkeypatch):
    texts = ["abc def", "A!!b--c", "x", "", None, "1234", "żółć 😀 e", " lead", "many   blanks\n\n here"]
    for block in (1 << 20, 3):
        monkeypatch.setattr(G, "BLOCK", block)
        for t in texts:
            got = G.gram_hashes(t)
            assert len(got) == len(grams(t)), (block, t)
            assert len(set(got.tolist())) == len(set(grams(t)))


def test_bit_sliced_filter_against_sets():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, 2000, dtype=np.uint64) for _ in range(70)]  # more languages than one word holds
    rows = np.zeros((2, G.SLOTS), dtype=np.uint64)
    for i, s in enumerate(sets):
        for at in G.positions(s):
            np.bitwise_or.at(rows, (i // 64, at), np.uint64(1 << (i % 64)))
    f = G.Filters([f"{i:02d}" for i in range(70)], rows, [1] * 70)
    for i in (0, 63, 64, 69):
        hits = f.hits(sets[i])
        assert hits[i] == 2000 and np.delete(hits, i).max() <= 5


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    got = G.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out and lang <> lang_pred").count() == 0 and got.where("held_out").count() > 60
    assert got.where("score < 0.5").count() == 0


def test_edge_rows(spark):
    docs = edge.docs(spark)
    rows = {r.doc_id: r for r in G.identify(docs).collect()}
    assert len(rows) == len({r[0] for r in edge.rows()})
    for i in (0, 1, 2, 14, 15):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert {r.lang_pred for r in rows.values()} <= {"en", "fr", "und"} and not rows[None].held_out
    assert G.identify(edge.empty(spark)).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in G.identify(unlabelled).collect()} == {"und"}


def test_keep_identified(spark):
    docs = corpus(spark).withColumn("score", F.lit("clash"))
    more = docs.limit(1).select(F.lit(-1).cast("bigint").alias("doc_id"), F.lit("12 !!").alias("text"), "lang", "score")
    junk = docs.limit(1).select(F.lit(-2).cast("bigint").alias("doc_id"), F.lit("xqzj wvkf " * 40).alias("text"), F.lit(None).alias("lang"), "score")
    kept = G.keep_identified(docs.union(more).union(junk))
    assert kept.columns == docs.columns and edge.count(kept) == edge.count(docs)


def test_words_of_spark_are_the_positions(spark):
    rng = np.random.default_rng(5)
    grams = rng.integers(-2**63, 2**63 - 1, 300)
    rows = [(int(g), int(i)) for i, g in enumerate(grams)]
    got = {(r.word, r.slot): r.bits for r in G._words(spark.createDataFrame(rows, "gram bigint, i bigint")).collect()}
    want = {}
    for g, i in rows:
        for slot in G.positions(np.array([g], dtype=np.int64).view(np.uint64))[:, 0]:
            want[i // 64, int(slot)] = want.get((i // 64, int(slot)), 0) | 1 << (i % 64)
    assert {k: v % 2**64 for k, v in got.items()} == want


def test_languages_beyond_one_group(spark):
    """2,000 languages of one word each (an invented language has an own alphabet of syllables), in groups of 64 and of 512."""
    rng = random.Random(9)
    own = {f"l{i:04d}": "".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(12)) for i in range(2000)}
    docs = spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(own.items())] + [(-1, "12", None), (-2, "qqqq", None)],
                                 "doc_id bigint, text string, lang string")
    few = docs.where("doc_id < 130")
    for rows, group in ((few, 64), (few, G.GROUP), (docs, G.GROUP)):
        got = {r.doc_id: (r.lang, r.lang_pred, r.score) for r in G.predict(rows, G.train(rows, group=group)).collect()}
        assert got.pop(-1)[1:] == ("und", 0.0) and got.pop(-2)[1:] == ("l0000", 0.0)  # all languages have the same number of n-grams
        assert all(lang == pred and score > 0.9 for lang, pred, score in got.values()) and len(got) == rows.count() - 2
