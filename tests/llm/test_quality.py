from collections import Counter
import re

from quarry.llm import op5_quality as Q
from tests.llm import edge


def base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {k for i in range(len(w) - 4) if at[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [l for l in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed


def judged(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: r for r in Q.judge(df).collect()}


def test_base_counts_by_definition(spark):
    repeated = edge.prose(4, 40, 50)
    texts = [r[1] for r in edge.rows()] + [repeated + " " + repeated, repeated + " x " + " ".join(repeated.split()[:7]),
                                           "a a a a a a a", "a b c d e " * 30, "#*$%&|<> " * 4, "l one\nl one\nl one \n\n \nm"]
    got = judged(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), (i, t)


def test_line_rules(spark):
    prose = "This line is plain prose with a good number of words in it and an end."
    menu, stock = "Home | News | Sports | Weather | About", "Please accept cookies to go on"
    shout = "BUY!! NOW!! CHEAP!! ONLY!! TODAY!!"
    texts = [prose + "\n" + menu, menu + "\n" + stock + "\n" + shout + " a b c d e", prose, prose + "\n" + stock + "\nAnother line follows it, no less plain than the first."]
    got = judged(spark, texts)
    assert [got[i].kept for i in range(4)] == [True, False, True, True]
    assert got[0].text_clean == prose and got[3].lines_removed == 1 and got[1].lines_removed == 3


def test_edge_rows(spark):
    out = Q.judge(edge.docs(spark))
    assert edge.count(out) == len(edge.rows())
    assert Q.judge(edge.empty(spark)).collect() == []


def test_long_navigation_lines(spark):
    """Patterns with repeated groups take any number of repeats without the regex engine running out of stack."""
    prose = "\n".join(f"Plain line number {i} says something of its own." for i in range(8))
    got = judged(spark, [prose + "\n" + "a·" * 200_000, prose + "\n" + "label |" * 50_000, "x " * 100_000 + "|" * 10])
    assert got[0].text_clean == got[1].text_clean == prose and got[0].lines_removed == 1
