"""Perplexity, multiple choice, reports, language ID, bigram LM."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

import numpy as np

from quarry.operators import evaluate as EV
from quarry.operators import langid as LI
from quarry.operators import lm as LM
from quarry.operators import tokens as TK
from quarry.plans import evaluation as EVR


def test_perplexity_and_empty(spark):
    sc = spark.createDataFrame([(1, 2_000_000, 4), (2, 1_000_000, 2)], "id long, nll long, n_tokens long")
    r = EV.perplexity(sc).collect()[0]
    assert r.n_tokens == 6 and r.nll_sum == pytest.approx(3.0) and r.loss == pytest.approx(0.5)
    assert r.perplexity == pytest.approx(math.exp(0.5))
    e = EV.perplexity(sc.where("id < 0")).collect()[0]
    assert (e.n_tokens, e.loss, e.perplexity) == (0, 0.0, 1.0)


def test_predict_ties_lowest_index_and_accuracy(spark):
    scores = spark.createDataFrame([(1, 0, 5.0), (1, 1, 3.0), (1, 2, 3.0), (2, 0, 1.0), (2, 1, 1.0)],
                                   "item_id long, choice_index int, score double")
    pred = {r.item_id: r.pred for r in EV.predict(scores).collect()}
    assert pred == {1: 1, 2: 0}
    gold = spark.createDataFrame([(1, 1), (2, 7)], "item_id long, gold int")  # out-of-range gold -> wrong
    a = EV.accuracy(EV.predict(scores), gold).collect()[0]
    assert (a.correct, a.total, a.accuracy) == (1, 2, 0.5)
    unscored = EV.accuracy(EV.predict(scores.where("item_id < 0")), gold).first()
    assert (unscored.correct, unscored.total, unscored.accuracy) == (0, 2, 0.0)  # every gold item counts
    empty = EV.accuracy(EV.predict(scores), gold.limit(0)).first()
    assert (empty.total, empty.accuracy) == (0, 0.0)


def test_perplexity_of_mean_losses(spark):
    losses = spark.createDataFrame([(1, 0.5, 10), (2, 2.0, 30), (3, 9.0, 0)], "id long, loss double, n_tokens long")
    row = EV.perplexity_of_losses(losses).first()
    assert row.n_tokens == 40 and math.isclose(row.loss, 65 / 40, rel_tol=1e-9) and math.isclose(row.perplexity, math.exp(65 / 40), rel_tol=1e-9)
    doc = json.loads(EV.perplexity_json(EV.perplexity_of_losses(losses)).first().value)
    assert doc["n_tokens"] == 40 and set(doc) == {"perplexity", "loss", "n_tokens"}
    assert EV.perplexity_of_losses(losses.limit(0)).first().perplexity == 1.0


def test_items_without_choices_fail(spark):
    items = spark.createDataFrame([(1, "q", [], 0)], "item_id long, question string, choices array<string>, answer_index int")
    with pytest.raises(Exception, match="no choices in item 1"):
        EV.expand_choices(items).collect()


def test_expand_choices_prompt(spark):
    items = spark.createDataFrame([(1, "Ile?", ["2", "4"], 1)], "item_id long, question string, choices array<string>, answer_index int")
    rows = EV.expand_choices(items).orderBy("choice_index").collect()
    assert [r.prompt for r in rows] == ["Ile?\nOdpowiedz: 2", "Ile?\nOdpowiedz: 4"]


def test_suite_skips_missing_file_and_unknown_kind(spark, tmp_path):
    benchmarks = {"mc": {"kind": "multiple_choice", "path": str(tmp_path / "missing.jsonl")},
                  "odd": {"kind": "generation"}}
    with pytest.warns(UserWarning):
        rep = EV.run_suite(spark, ["mc", "odd"], benchmarks, {"multiple_choice": None, "perplexity": None}).collect()
    assert len(rep) == 1 and math.isnan(rep[0].value) and rep[0].extra == {"skipped": 1.0}
    with pytest.raises(KeyError):
        EV.run_suite(spark, ["nope"], benchmarks, {})


def _files(tmp_path):
    for name, rows in (("held.jsonl", [{"body": "cat dog cat"}, {"body": ""}, {"body": "dog " * 50}, {"other": "x"}]),
                       ("mc.jsonl", [{"question": "cat", "choices": ["zzz", "dog"], "answer_index": 1},
                                     {"question": "cat", "choices": ["dog", "zzz"], "answer_index": 1}])):
        (tmp_path / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    return {"ppl": {"path": str(tmp_path / "held.jsonl"), "text_field": "body"},
            "mc": {"kind": "multiple_choice", "path": str(tmp_path / "mc.jsonl")},
            "gone": {"kind": "multiple_choice", "path": str(tmp_path / "no.jsonl")}, "odd": {"kind": "generation"}}


def test_suite_from_files(spark, tmp_path):
    """A scorer that costs a text its length, and 100 more where it holds zzz."""
    benchmarks, seen = _files(tmp_path), []

    def scorer(rows, most):
        seen.append(most)
        return rows.select("id", (F.length("text") + 100 * F.contains("text", F.lit("zzz")).cast("int")).alias("nll"), F.lit(1).alias("n_tokens"))
    out = str(tmp_path / "report")
    with pytest.warns(UserWarning, match="generation"):
        report = EVR.run(spark, "ckpt", "all", out, {"all": ["ppl", "mc", "gone", "odd"]}, benchmarks, scorer)
    rows = {r.name: r for r in report.collect()}
    assert set(rows) == {"ppl", "mc", "gone"} and seen == [EVR.MAX_SEQ_LENGTH, None]
    assert rows["ppl"].extra["n_tokens"] == 2 and rows["ppl"].extra["loss"] == pytest.approx((11 + 200) / 2 / 1e6)
    assert (rows["mc"].value, rows["mc"].extra) == (0.5, {"correct": 1.0, "total": 2.0})
    assert math.isnan(rows["gone"].value) and rows["gone"].extra == {"skipped": 1.0}
    back = {r.name: r for r in EVR.read_report(spark, out).collect()}
    assert set(back) == set(rows) and {(r.checkpoint, r.suite) for r in back.values()} == {("ckpt", "all")}
    assert back["mc"].extra == rows["mc"].extra and math.isnan(back["gone"].value)


def test_unknown_suite_and_benchmark_raise_before_scoring(spark, tmp_path):
    def scorer(rows, most):
        raise AssertionError("scored")
    benchmarks = _files(tmp_path)
    with pytest.raises(KeyError, match="polish.*known: all"):
        EVR.run(spark, "c", "polish", str(tmp_path / "o"), {"all": ["ppl"]}, benchmarks, scorer)
    with pytest.raises(KeyError, match="nope"):
        EVR.run(spark, "c", "all", str(tmp_path / "o"), {"all": ["ppl", "nope"]}, benchmarks, scorer)
    assert not (tmp_path / "o").exists()


def test_lm_scorer_cuts_at_the_most_tokens(spark):
    train = spark.createDataFrame([(1, "cat dog cat dog")], "doc_id long, text string")
    vocab = TK.build_vocab(train, "text", 10)
    score = EVR.lm_scorer(vocab, LM.train(TK.tokenize(train, vocab)), 14)
    rows = spark.createDataFrame([(7, "cat dog " * 20), (8, None)], "id long, text string")
    assert {r.id: r.n_tokens for r in score(rows, 5).collect()} == {7: 6, 8: 1}
    assert {r.id: r.n_tokens for r in score(rows, None).collect()} == {7: 41, 8: 1}


def test_lookup_and_join_agree(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(4, 12) for _ in range(rng.randrange(30))]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    model = LM.train(df.where("doc_id < 20"))
    one, two = ({tuple(r) for r in LM.nll(df, model, 12, 0.5, model_rows=n).select("doc_id", "nll", "n_tokens").collect()} for n in (10**6, 0))
    assert one == two and len(one) == 60
    texts = spark.createDataFrame([(i, "".join(rng.choice("abcde \nŻ\U0001F600") for _ in range(rng.randrange(40)))) for i in range(80)] + [(99, None)],
                                  "doc_id long, text string")
    labelled = texts.where("doc_id < 40").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    trained = LI.train(labelled)
    one, two = ({(r.doc_id, r.label, round(r.score, 12)) for r in LI.score(texts, trained, model_cells=n).collect()} for n in (10**6, 0))
    assert one == two and one
    plan = LI.score(texts, trained)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no gram is shuffled


def test_compare_reports(spark):
    base = spark.createDataFrame([("ppl", 100.0), ("mc", 0.40), ("en", 0.60)], "name string, value double")
    cand = spark.createDataFrame([("ppl", 70.0), ("mc", 0.42), ("en", 0.59)], "name string, value double")
    out = {r.name: r.passed for r in EV.compare_reports(base, cand, {"ppl": ("rel_drop", 0.25), "mc": ("min_gain", 0.03),
                                                                     "en": ("max_drop", 0.02)}).collect()}
    assert out == {"ppl": True, "mc": False, "en": True}


def test_langid_train_and_score(spark):
    rows = [(1, "the cat and the dog are in the house", "en"), (2, "le chat et le chien sont dans la maison", "fr"),
            (3, "the house is big and the dog is old", "en"), (4, "la maison est grande et le chien est vieux", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = LI.train(df)
    test = spark.createDataFrame([(10, "the dog and the cat"), (11, "le chien et la maison"), (12, "zzzz qqqq")],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.label, r.score) for r in LI.with_scores(test, model).collect()}
    assert got[10][0] == "en" and got[11][0] == "fr" and got[10][1] > 0.5
    assert got[12] == (None, None)  # no known trigram: no label, fails any gate


def test_bigram_lm(spark):
    train = spark.createDataFrame([(1, [4, 5, 6]), (2, [4, 5])], "doc_id long, ids array<int>")
    model = LM.train(train)
    sc = LM.nll(spark.createDataFrame([(9, [4, 5])], "doc_id long, ids array<int>"), model, n_ids=7, k=1.0).collect()[0]
    # pairs: (2,4) c=2 cv=2; (4,5) c=2 cv=2; (5,3) c=1 cv=2 -> p = 3/9, 3/9, 2/9
    expect = sum(round(-math.log(p) * 1e6) for p in (3 / 9, 3 / 9, 2 / 9))
    assert (sc.nll, sc.n_tokens) == (expect, 3)


def test_langid_counts_in_tasks(spark):
    import collections

    rows = [("a", "Abc\nabc \U0001F600xy"), ("b", "abcabc"), ("a", "ab"), (None, "abcd"), ("b", None), ("c", ""), ("a", "zażółć " * 50)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    want = collections.Counter((l, t.lower().replace("\n", " ")[i:i + 3]) for l, t in rows if l and t for i in range(len(t) - 2))
    totals = {l: sum(c for (k, _), c in want.items() if k == l) for l in "ab"}
    v = len({g for _, g in want})
    for held in (1, LI.HELD):
        model, priors = LI.train(df, held=held)
        lp = {(l, g): round(math.log((c + 1) / (totals[l] + v)) * 1e6) for (l, g), c in want.items()}
        assert {(r.lang, r.gram): r.lp for r in model.collect()} == lp
        assert {r.lang: r.lp0 for r in priors.collect()} == {l: round(math.log(1 / (n + v)) * 1e6) for l, n in totals.items()}


def test_langid_places_by_table_and_by_search(monkeypatch):
    text = "zażółć gęślą \U0001F600 jaźń abcabc"
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    grams = np.unique(LI._packed(codes[:20]))
    table = LI._Places(grams)
    monkeypatch.setattr(LI, "TABLE", 0)
    search = LI._Places(grams)
    assert table.table is not None and search.table is None
    want = [int(np.searchsorted(grams, g)) for g in LI._packed(codes) if g in grams]
    assert table.of(codes).tolist() == search.of(codes).tolist() == want
