import random

import numpy as np
import pytest

from quarry.llm import op4_toxic as T
from tests.llm import edge


def slow_kernel(a, b):
    """The definition, subsequence by subsequence."""
    def weights(t):
        out = {}
        for i in range(len(t)):
            for j in range(i + 1, len(t)):
                for k in range(j + 1, min(len(t), i + T.SPAN)):
                    out[t[i] + t[j] + t[k]] = out.get(t[i] + t[j] + t[k], 0) + T.LAMBDA ** (k - i + 1)
        return out
    x, y = weights(a), weights(b)
    both = sum(v * y.get(u, 0) for u, v in x.items())
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return (both / norm) ** T.POWER if norm else 0.0


def test_kernel_by_definition():
    marks = ["idiot", "abcabc", "zzz", "worthless"]
    tokens = ["idiot", "idxiot", "id", "", "cabcab", "zzzzzz", "worthles", "żółć😀x", "a" * 300]
    got = T.Landmarks(marks).kernel(tokens)
    want = [[slow_kernel(t, m) for m in marks] for t in tokens]
    assert np.allclose(got, want)


def test_sentences_and_spaced_letters():
    assert T.sentences("You i d i o t now. C d\ng!") == [["you", "idiot", "now."], ["c", "d"], ["g!"]]
    assert T.clean("i.d-iot!") == "idiot" and T.sentences(None) == [] and T.sentences(" \n ") == []


def test_long_tokens_in_blocks(monkeypatch):
    marks = T.Landmarks(["idiot", "abcabc", "worthless"])
    tokens = ["".join(random.Random(i).choices("abcidot", k=n)) for i, n in enumerate((40, 700, 3000))]
    whole = marks.kernel(tokens)
    monkeypatch.setattr(T, "LONG", 30)
    monkeypatch.setattr(T, "CHUNK", 640)
    assert np.allclose(marks.kernel(tokens), whole) and whole.max() > 0


def test_a_token_of_millions_of_characters():
    assert T.Landmarks(["idiot"]).kernel(["idiot" * 600_000]).shape == (1, 1)


def test_a_bag_holds_the_tokens_of_all_sentences():
    for text in ("You i d i o t now. C d\ng!", "a b c d\ne f g h\n", "", None, "x. y! z?"):
        assert T.bag(text) == {t for s in T.sentences(text) for t in s}


def test_margins_do_not_depend_on_grouping(model, monkeypatch):
    texts = [t for _, t in corpus()[0][:60]] + [None, "", "nitwit"]
    whole = model.margins(texts)
    monkeypatch.setattr(T, "TEXTS", 200)
    monkeypatch.setattr(T, "CACHE", 50)
    assert model.margins(texts) == pytest.approx(whole) == [model.margins([t])[0] for t in texts]


def corpus():
    rng, insults = random.Random(5), ["blockhead", "nitwit", "dunderpate"]
    rows, labels = [], []
    for i in range(400):
        words = [f"{a}{b}" for a, b in ((rng.choice("abcdefg") * 2, rng.choice(["on", "er", "at", "in"]) + rng.choice("xyz")) for _ in range(30))]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(insults)
        rows.append((i, " ".join(words[:15]) + ". " + " ".join(words[15:])))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    return T.train(spark.createDataFrame(rows[:300], "doc_id bigint, text string"),
                   spark.createDataFrame(labels[:300] + [(None, 1), (1, None)], "doc_id bigint, toxic int"))


def test_held_out_accuracy(model):
    rows, labels = corpus()
    hits = [(model.score(t) >= T.CUT) == bool(y) for (_, t), (_, y) in zip(rows[300:], labels[300:])]
    assert sum(hits) >= 98


def test_disguised_insults(model):
    for text in ("you nitwit", "you n.i.t.w.i.t", "you n i t w i t there", "you nit-wit"):
        assert model.score(text) >= T.CUT, text
    assert model.score("you nitwxit") > model.score("you aaonx")
    assert model.score("") < T.CUT and model.score(None) == model.score("")


def test_edge_rows(spark, model):
    out = T.score(edge.docs(spark), model)
    assert edge.count(out) == len(edge.rows()) and all(0 <= r.score <= 1 for r in out.select("score").collect())
    assert T.score(edge.empty(spark), model).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert T.train(edge.docs(spark), none) is None
    assert {r.score for r in T.score(edge.docs(spark), None).select("score").collect()} == {0.0}


def test_a_sample_keeps_the_scores_of_the_whole(spark):
    """A word of 30 toxic and 120 clean documents has the same chance of a toxic one when only 50 rows of each are taken."""
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        word = "grumbler" if (i // 6 % 10 < 3 if toxic else i % 25 < 6) else "blockhead" if toxic else "gentle"
        rows.append((i, f"aaonx n{i:03d} {word} ccatx."))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    whole, sampled = (T.train(docs, known, sample=n) for n in (3000, 50))
    for text in ("aaonx grumbler ccatx.", "aaonx gentle ccatx.", "aaonx blockhead ccatx."):
        assert (whole.score(text) >= T.CUT) == (sampled.score(text) >= T.CUT), text
        assert abs(whole.score(text) - sampled.score(text)) < 0.1, (text, whole.score(text), sampled.score(text))
