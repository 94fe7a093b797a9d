"""User scorers and tokenizers: shapes, checks, nulls, one load in each worker, through preparation and packing."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.operators import plugins as PL
from quarry.operators import tokens as TK
from quarry.plans import prepare as P
from quarry.plans.options import PackOptions, PrepareOptions


def vowels():
    """Label by the first letter, score by the share of vowels."""
    def score(texts):
        found = texts.to_pylist()
        return [t[:1] for t in found], [sum(c in "aeiou" for c in t) / max(1, len(t)) for t in found]
    return score


def words():
    return lambda texts: [[len(w) for w in t.split()] for t in texts.to_pylist()]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_scores_stay_with_their_rows(spark):
    texts = ["aeb", None, "", "xyz", "oooo", None, "e" * 50]
    got = {r.doc_id: r.s and tuple(r.s) for r in frame(spark, texts).select("doc_id", PL.scored(PL.Plugin(vowels), F.col("text")).alias("s")).collect()}
    assert got == {0: ("a", 2 / 3), 1: None, 2: ("", 0.0), 3: ("x", 0.0), 4: ("o", 1.0), 5: None, 6: ("e", 1.0)}


def test_texts_come_in_slices_of_bounded_size():
    texts = pa.array(["ab", "cdefgh", None, "i", "", "jk"])
    parts = list(PL.slices(texts, 3))
    assert pa.concat_arrays(parts).equals(texts) and [len(p) for p in parts] == [1, 1, 4]
    assert list(PL.slices(texts.slice(0, 0))) == []
    plugin = PL.Plugin(vowels)
    whole = PL._answers(plugin, texts, PL._scores, PL._SCORE_ARROW)
    assert [x and x["label"] for x in whole.to_pylist()] == ["a", "c", None, "i", "", "j"]


@pytest.mark.parametrize("load, says", [
    (lambda: lambda texts: ([1.5], [0.5]), "labels of odd"),
    (lambda: lambda texts: (["a"] * (len(texts) + 1), [0.5] * len(texts)), "labels of odd for"),
    (lambda: lambda texts: (["a"] * len(texts), ["high"] * len(texts)), "scores of odd must be double"),
    (lambda: lambda texts: None, "odd must return labels and scores")])
def test_wrong_answers_fail_with_the_name(spark, load, says):
    with pytest.raises(Exception, match=says):
        frame(spark, ["x", "y"]).coalesce(1).select(PL.scored(PL.Plugin(load, "odd"), F.col("text"))).collect()


@pytest.mark.parametrize("ids", [[None], [[1, None]], [["a"]], [[2**40]], [[1], [2]]])
def test_wrong_ids_fail(ids):
    with pytest.raises(ValueError, match="odd"):
        PL._answers(PL.Plugin(lambda: lambda texts: ids, "odd"), pa.array(["x"]), PL._ids, PL._IDS_ARROW)


def test_a_model_is_loaded_once_and_few_are_held():
    loads = []
    plugins = [PL.Plugin(lambda i=i: loads.append(i) or vowels()) for i in range(PL.HELD + 1)]
    for _ in range(3):
        PL.model_of(plugins[0])
    assert loads == [0]
    for p in plugins:
        PL.model_of(p)
    assert len(PL._MODELS) <= PL.HELD and loads == list(range(PL.HELD + 1))


def test_loads_are_no_more_than_workers(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        open(os.path.join(folder, f"{os.getpid()}-{len(os.listdir(folder))}"), "w").close()
        return vowels()
    plugin = PL.Plugin(load)
    for _ in range(2):
        assert spark.range(4000).repartition(16).select(PL.scored(plugin, F.col("id").cast("string")).alias("s")).where("s.score = 0").count() == 4000
    pids = [f.split("-")[0] for f in os.listdir(folder)]
    assert len(pids) == len(set(pids))


def test_scorer_as_language_gate(spark):
    docs = frame(spark, ["aaaa" * 20, "abcd" * 20, "aaaa" * 20, "bbbb" * 20, None, "a"])
    opts = PrepareOptions(min_chars=50, lang="a", lang_scorer=PL.Plugin(vowels), lang_min_score=0.25)
    got = {r.doc_id: r.reason for r in P.classify(docs, opts).collect()}
    assert got == {0: "kept", 1: "kept", 2: "dup", 3: "lang", 4: "empty", 5: "short"}
    assert P.quick_stats(docs, opts).first() == P.stats(P.classify(docs, opts)).first()


def test_tokenizer_through_pack(spark):
    docs = frame(spark, ["a bb ccc", None, "", "dddd"])
    ids = TK.tokenize_with(docs, PL.Plugin(words), out="ids")
    assert {r.doc_id: r.ids for r in ids.collect()} == {0: [1, 2, 3], 1: [], 2: [], 3: [4]}
    packed = TK.pack(ids, PackOptions(seq_len=3, buckets=1)).collect()
    assert sum(r.n_tokens for r in packed) == 4 + 4 and all(r.n_tokens <= 3 for r in packed)
