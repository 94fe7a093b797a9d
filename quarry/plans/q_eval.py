"""Registered queries: bigram LM scores, perplexity, multiple-choice evaluation, reports.

Fixture mapping: the LM is trained on the train split of the prepared corpus
and scores its val split. Multiple-choice items are derived from ``benchmark``:
question = first half of an item's text; the four choices are the second halves
of the items at shuffled ranks r .. r+3 (mod n), rotated by a seeded hash so the
right answer (the item's own second half) sits at index ``rot``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import evaluate as EV
from quarry.operators import lm as LM
from quarry.operators import sampling as SM
from quarry.operators import tokens as TK
from quarry.plans import evaluation as EVR
from quarry.plans import sql as S
from quarry.plans.q_sampling import kept
from quarry.plans.q_tokens import tokens_sql
from quarry.plans.registry import query, table
from quarry.session import stage, staging_dir
from quarry.sources import jsonl

SEED = 42
VOCAB = 4096
N_IDS = VOCAB + TK.N_RESERVED
K_BASE = 1.0
K_CAND = 0.1
TARGETS = {"heldout_ppl": ("rel_drop", 0.25), "mcqa": ("min_gain", 0.03)}


# ---------------------------------------------------------------- Spark side

def _corpus(spark, sf_dir):
    sp = SM.split_train_val(kept(spark, sf_dir), "doc_hash", SEED, 0.05)
    # the texts are joined with their duplicates and split into tokens once, for the vocabulary and the ids
    sp = stage(sp.select("doc_id", TK.token_strings(F.col("norm_text")).alias("tokens"), "split"), "tokens")
    vocab = TK.build_vocab(sp.where(F.col("split") == "train"), "tokens", VOCAB)
    ids = stage(TK.tokenize(sp, vocab, "tokens", "doc_id", carry=("split",)), "ids")
    model = LM.train(ids.where(F.col("split") == "train"))
    return vocab, ids, model


def _val_nll(spark, sf_dir, k=K_BASE, corpus=None):
    vocab, ids, model = corpus or _corpus(spark, sf_dir)
    return LM.nll(ids.where(F.col("split") == "val"), model, N_IDS, k)


def _mcqa_items(spark, sf_dir):
    """(item_id, question, choices, answer_index): four choices an item."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    n = b.agg(F.count(F.lit(1))).scalar()
    h = SM.seeded_hash(SEED, F.col("item_id"))
    cut = (F.length("text") / 2).cast("int")
    items = b.select("item_id", F.col("text").substr(F.lit(1), cut).alias("question"),
                     F.col("text").substr(cut + 1, F.length("text") - cut).alias("tail"),
                     (F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint") % 4).alias("rot"))
    ranked = SM.shuffle_rank(items, "item_id", SEED, out="r")
    picks = ranked.select("item_id", "question", "rot", "r", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"))
    picks = picks.withColumn("nr", (F.col("r") + F.col("j")) % n)
    tails = ranked.select(F.col("r").alias("nr"), F.col("tail").alias("choice"))
    placed = picks.join(tails, on="nr").select("item_id", "question", "rot", F.struct(
        ((F.col("j") + F.col("rot")) % 4).alias("i"), "choice").alias("c"))
    return placed.groupBy("item_id").agg(
        F.first("question").alias("question"), F.transform(F.array_sort(F.collect_list("c")), lambda c: c["choice"]).alias("choices"),
        F.first("rot").alias("answer_index"))


def _mcqa_rows(spark, sf_dir):
    items = stage(_mcqa_items(spark, sf_dir), "mcqa-items")
    rows = EV.expand_choices(items).select("item_id", F.col("choice_index").cast("bigint").alias("choice_index"), "prompt")
    return rows, items.select("item_id", F.col("answer_index").alias("gold"))


def _mcqa_scores(spark, sf_dir, k=K_BASE, corpus=None):
    vocab, _ids, model = corpus or _corpus(spark, sf_dir)
    rows, gold = _mcqa_rows(spark, sf_dir)
    rows = rows.withColumn("pid", F.concat_ws(":", "item_id", "choice_index"))
    pids = TK.tokenize(rows, vocab, "prompt", "pid", carry=("item_id", "choice_index"))
    sc = LM.nll(pids, model, N_IDS, k, key_col="pid")
    scores = pids.select("pid", "item_id", "choice_index").join(sc, on="pid").select(
        "item_id", "choice_index", F.col("nll").alias("score"))
    return scores, gold


def _report(spark, sf_dir, k, corpus):
    ppl = EV.perplexity(_val_nll(spark, sf_dir, k, corpus))
    scores, gold = _mcqa_scores(spark, sf_dir, k, corpus)
    acc = EV.accuracy(EV.predict(scores), gold)
    return EV.perplexity_report("heldout_ppl", ppl).unionByName(EV.mcqa_report("mcqa", acc))


# ---------------------------------------------------------------- SQL side

def _lm_cte() -> str:
    return f"""{S.kept()},
sp AS (SELECT doc_id, norm_text, {S.split_case('doc_hash', SEED, 0.05)} AS split FROM kept),
tok AS (SELECT doc_id, split, {tokens_sql('norm_text')} AS toks FROM sp),
cnt AS (SELECT t AS token, count(*) AS count FROM (SELECT unnest(toks) AS t FROM tok WHERE split = 'train') GROUP BY t),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY count DESC, token) + 3 AS INTEGER) AS id FROM cnt
          QUALIFY row_number() OVER (ORDER BY count DESC, token) <= {VOCAB}),
pos AS (SELECT doc_id, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos FROM tok),
ids AS (SELECT p.doc_id, list(coalesce(v.id, 1) ORDER BY p.pos) AS ids FROM pos p LEFT JOIN vocab v USING (token)
        GROUP BY p.doc_id),
seqs AS (SELECT i.doc_id, s.split, list_concat([2], i.ids, [3]) AS seq FROM ids i JOIN sp s USING (doc_id)),
prs AS (SELECT doc_id, split, seq[j] AS v, seq[j + 1] AS w FROM (SELECT *, unnest(range(1, len(seq))) AS j FROM seqs)),
big AS (SELECT v, w, count(*) AS c FROM prs WHERE split = 'train' GROUP BY ALL),
ctx AS (SELECT v, sum(c) AS cv FROM big GROUP BY v)"""


def _term(k: float) -> str:
    return (f"CAST(round(-ln((coalesce(b.c, 0) + CAST({k!r} AS DOUBLE)) / "
            f"(coalesce(x.cv, 0) + CAST({k * N_IDS!r} AS DOUBLE))) * 1e6) AS BIGINT)")


def _nll_cte(k: float, name: str = "nll") -> str:
    return (f"{name} AS (SELECT p.doc_id, sum({_term(k)}) AS nll, count(*) AS n_tokens FROM prs p "
            f"LEFT JOIN big b USING (v, w) LEFT JOIN ctx x USING (v) WHERE p.split = 'val' GROUP BY p.doc_id)")


_MCQA_CTE = f"""items AS (SELECT item_id, text, length(text) // 2 AS cut, {S.seeded_hash(SEED, 'item_id')} AS h FROM benchmark),
rk AS (SELECT *, row_number() OVER (ORDER BY h, item_id) - 1 AS r, count(*) OVER () AS n,
       CAST(CAST(('0x' || substr(h, 9, 8)) AS UBIGINT) % 4 AS BIGINT) AS rot FROM items),
ch AS (SELECT a.item_id, (a.j + a.rot) % 4 AS choice_index,
       substr(a.text, 1, a.cut) || chr(10) || 'Odpowiedz: ' || substr(b.text, b.cut + 1) AS prompt
       FROM (SELECT *, unnest(range(0, 4)) AS j FROM rk) a JOIN rk b ON b.r = (a.r + a.j) % a.n),
gold AS (SELECT item_id, rot AS gold FROM rk)"""


def _mcqa_score_cte(k: float, name: str = "mscore") -> str:
    return f"""mt_{name} AS (SELECT item_id, choice_index, {tokens_sql('prompt')} AS toks FROM ch),
mp_{name} AS (SELECT item_id, choice_index, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos FROM mt_{name}),
mi_{name} AS (SELECT m.item_id, m.choice_index, list(coalesce(v.id, 1) ORDER BY m.pos) AS ids
      FROM mp_{name} m LEFT JOIN vocab v USING (token) GROUP BY ALL),
ms_{name} AS (SELECT item_id, choice_index, list_concat([2], ids, [3]) AS seq FROM mi_{name}),
mq_{name} AS (SELECT item_id, choice_index, seq[j] AS v, seq[j + 1] AS w FROM (SELECT *, unnest(range(1, len(seq))) AS j FROM ms_{name})),
{name} AS (SELECT p.item_id, p.choice_index, sum({_term(k)}) AS score FROM mq_{name} p
      LEFT JOIN big b USING (v, w) LEFT JOIN ctx x USING (v) GROUP BY ALL),
pred_{name} AS (SELECT item_id, arg_min(choice_index, (score, choice_index)) AS pred FROM {name} GROUP BY item_id),
acc_{name} AS (SELECT count_if(p.pred = g.gold) AS correct, count(*) AS total,
      CASE WHEN count(*) > 0 THEN count_if(p.pred = g.gold) / count(*) ELSE 0.0 END AS accuracy
      FROM pred_{name} p JOIN gold g USING (item_id))"""


def _ppl_select(nll: str) -> str:
    return (f"SELECT CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS n_tokens, coalesce(sum(nll), 0) / 1e6 AS nll_sum, "
            f"(coalesce(sum(nll), 0) / 1e6) / greatest(coalesce(sum(n_tokens), 0), 1) AS loss FROM {nll}")


def _report_cte(k: float, tag: str) -> str:
    return (f"{_nll_cte(k, 'nll_' + tag)}, ppl_{tag} AS ({_ppl_select('nll_' + tag)}), {_mcqa_score_cte(k, 'sc_' + tag)}, "
            f"rep_{tag} AS (SELECT 'heldout_ppl' AS name, 'perplexity' AS kind, 'perplexity' AS metric, exp(loss) AS value "
            f"FROM ppl_{tag} UNION ALL SELECT 'mcqa', 'multiple_choice', 'accuracy', accuracy FROM acc_sc_{tag})")


# ---------------------------------------------------------------- queries


@query("ngram_lm_nll", f"WITH {_lm_cte()}, {_nll_cte(K_BASE)} SELECT doc_id, nll, n_tokens FROM nll")
def q_ngram_lm_nll(spark, sf_dir):
    return _val_nll(spark, sf_dir).select("doc_id", "nll", "n_tokens")


@query("perplexity", f"WITH {_lm_cte()}, {_nll_cte(K_BASE)}, ppl AS ({_ppl_select('nll')}) "
       "SELECT n_tokens, round(nll_sum, 6) AS nll_sum, round(loss, 6) AS loss, round(exp(loss), 6) AS perplexity FROM ppl")
def q_perplexity(spark, sf_dir):
    p = EV.perplexity(_val_nll(spark, sf_dir))
    return p.select("n_tokens", *[F.round(c, 6).alias(c) for c in ("nll_sum", "loss", "perplexity")])


@query("mcqa_prompts", f"WITH {_MCQA_CTE} SELECT item_id, choice_index, sha1(prompt) AS prompt_sha1 FROM ch")
def q_mcqa_prompts(spark, sf_dir):
    rows, _ = _mcqa_rows(spark, sf_dir)
    return rows.select("item_id", "choice_index", TX.text_sha1(F.col("prompt")).alias("prompt_sha1"))


@query("mcqa_scores", f"WITH {_lm_cte()}, {_MCQA_CTE}, {_mcqa_score_cte(K_BASE)} SELECT item_id, choice_index, score FROM mscore")
def q_mcqa_scores(spark, sf_dir):
    scores, _ = _mcqa_scores(spark, sf_dir)
    return scores


@query("mcqa_predict", f"WITH {_lm_cte()}, {_MCQA_CTE}, {_mcqa_score_cte(K_BASE)} "
       "SELECT p.item_id, p.pred, g.gold FROM pred_mscore p JOIN gold g USING (item_id)")
def q_mcqa_predict(spark, sf_dir):
    scores, gold = _mcqa_scores(spark, sf_dir)
    return EV.predict(scores).join(gold, on="item_id")


@query("mcqa_accuracy", f"WITH {_lm_cte()}, {_MCQA_CTE}, {_mcqa_score_cte(K_BASE)} "
       "SELECT correct, total, round(accuracy, 6) AS accuracy FROM acc_mscore")
def q_mcqa_accuracy(spark, sf_dir):
    scores, gold = _mcqa_scores(spark, sf_dir)
    acc = EV.accuracy(EV.predict(scores), gold)
    return acc.select("correct", "total", F.round("accuracy", 6).alias("accuracy"))


@query("eval_report", f"WITH {_lm_cte()}, {_MCQA_CTE}, {_report_cte(K_BASE, 'b')} "
       "SELECT name, kind, metric, round(value, 6) AS value FROM rep_b")
def q_eval_report(spark, sf_dir):
    rep = _report(spark, sf_dir, K_BASE, _corpus(spark, sf_dir))
    return rep.select("name", "kind", "metric", F.round("value", 6).alias("value"))


@query("eval_suite_files", f"WITH {_lm_cte()}, {_MCQA_CTE}, {_report_cte(K_BASE, 'b')}, rows AS (SELECT name, kind, metric, value, false AS skipped "
       "FROM rep_b UNION ALL SELECT 'gone', 'multiple_choice', 'accuracy', NULL, true) "
       "SELECT 'base' AS checkpoint, 'all' AS suite, name, kind, metric, round(value, 6) AS value, skipped FROM rows")
def q_eval_suite_files(spark, sf_dir):
    """Held-out texts and multiple-choice items written as JSONL files, then a suite run on them: a text benchmark, a
    multiple-choice one, one whose file is missing and one of a kind that nobody knows; the written report is read again."""
    docs = SM.split_train_val(kept(spark, sf_dir), "doc_hash", SEED, 0.05)
    vocab, _ids, model = _corpus(spark, sf_dir)
    held = docs.where("split = 'val'").select(F.to_json(F.struct(F.col("norm_text").alias("body"))).alias("value"))
    items = _mcqa_items(spark, sf_dir).select(F.to_json(F.struct("question", "choices", "answer_index")).alias("value"))
    text_path, mcqa_path = (jsonl.write_lines(d, staging_dir(spark, n)) for d, n in ((held, "eval-heldout"), (items, "eval-mcqa")))
    benchmarks = {
        "heldout_ppl": {"kind": "perplexity", "path": text_path, "text_field": "body", "max_seq_length": None, "glob": "*.txt"},
        "mcqa": {"kind": "multiple_choice", "path": mcqa_path, "glob": "*.txt"},
        "gone": {"kind": "multiple_choice", "path": f"{mcqa_path}/none.jsonl"},
        "odd": {"kind": "generation"}}
    out = staging_dir(spark, "eval-out")
    EVR.run(spark, "base", "all", out, {"all": list(benchmarks)}, benchmarks, EVR.lm_scorer(vocab, model, N_IDS, K_BASE))
    rows = EVR.read_report(spark, out)
    return rows.select("checkpoint", "suite", "name", "kind", "metric", F.when(~F.isnan("value"), F.round("value", 6)).alias("value"),
                       F.coalesce(F.col("extra")["skipped"] == 1, F.lit(False)).alias("skipped"))


@query("perplexity_file", f"WITH {_lm_cte()}, {_nll_cte(K_BASE)}, ppl AS ({_ppl_select('nll')}) "
       "SELECT round(exp(loss), 6) AS perplexity, round(loss, 6) AS loss, n_tokens FROM ppl")
def q_perplexity_file(spark, sf_dir):
    """The perplexity of the held-out texts written as a JSON document and read again."""
    path = jsonl.write_lines(EV.perplexity_json(EV.perplexity(_val_nll(spark, sf_dir))), staging_dir(spark, "perplexity-json"))
    row = spark.read.schema("perplexity double, loss double, n_tokens bigint").json(path)
    return row.select(*[F.round(c, 6).alias(c) for c in ("perplexity", "loss")], "n_tokens")


_CMP_SQL = f"""WITH {_lm_cte()}, {_MCQA_CTE}, {_report_cte(K_BASE, 'b')}, {_report_cte(K_CAND, 'c')}
SELECT b.name, round(b.value, 6) AS base, round(c.value, 6) AS candidate, round(c.value - b.value, 6) AS delta,
  CASE WHEN b.name = 'heldout_ppl' THEN c.value <= b.value * CAST({1.0 - 0.25!r} AS DOUBLE)
       WHEN b.name = 'mcqa' THEN c.value - b.value >= CAST(0.03 AS DOUBLE) END AS passed
FROM rep_b b JOIN rep_c c USING (name)"""


@query("compare_reports", _CMP_SQL)
def q_compare_reports(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    base = _report(spark, sf_dir, K_BASE, corpus)
    cand = _report(spark, sf_dir, K_CAND, corpus)
    cmp = EV.compare_reports(base, cand, TARGETS)
    return cmp.select("name", *[F.round(c, 6).alias(c) for c in ("base", "candidate", "delta")], "passed")
