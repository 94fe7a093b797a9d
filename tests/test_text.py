"""Normalization, filters, fingerprints, mojibake."""

import unicodedata

from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import filters


def test_normalize_in_its_order(one_col):
    """Composition, then control characters go, then blanks fold: a control character between blanks leaves one."""
    got = one_col(TX.normalize_text, ["p \x02\t q\x7f", "\vre\x00d\f", "n\u0303o\u0308", "o\x1e\u0301"])
    assert got == ["p q", "red", "\u00f1\u00f6", "o\u0301"]


def test_normalize_edge_rows(one_col):
    vals = ["a\rb", "\u3000x\u00a0\u2003y", "\x85z", "a\u200bb", "", None, " \t ", "\x1cx\x1fy"]
    assert one_col(TX.normalize_text, vals) == ["ab", "x y", "z", "a\u200bb", "", None, "", "xy"]


def test_collapse_ws_matches_python(one_col):
    import re
    vals = ["a   b", "x\x1cy", "p q  r", " lead", "tail　"]
    expected = [re.sub(r"\s+", " ", v).strip() for v in vals]
    assert one_col(TX.collapse_ws, vals) == expected


def test_nfc_matches_python_on_mixed_text(one_col):
    import unicodedata
    vals = ["Zażółć", "été", "가", "plain ascii", "café"]
    assert one_col(TX.nfc, vals) == [unicodedata.normalize("NFC", v) for v in vals]


def test_length_bounds_are_inclusive(spark):
    sizes = [6, 7, 8, 19, 20, 21]
    df = spark.createDataFrame([("\u017c" * n,) for n in sizes], "t string")
    got = [r[0] for r in df.select(filters.length_ok(F.col("t"), 7, 20)).collect()]
    assert got == [7 <= n <= 20 for n in sizes]


def test_ngrams_on_astral_text(one_col):
    from quarry.operators import langid, near_dedup
    text = "\U0001F600ab\U0001F601cde"
    assert one_col(lambda c: langid.grams(c), [text]) == [[text[i:i + 3] for i in range(len(text) - 2)]]
    assert one_col(lambda c: near_dedup.shingles(c, 5), [text]) == [[text[i:i + 5] for i in range(len(text) - 4)]]


def test_length_counts_code_points(one_col):
    assert one_col(F.length, ["a\U0001F600b"]) == [3]


def test_sha1_fingerprint(one_col):
    import hashlib
    vals = ["zażółć gęślą jaźń", "abc"]
    assert one_col(TX.text_sha1, vals) == [hashlib.sha1(v.encode()).hexdigest() for v in vals]


def test_nonblank_vs_truthy(spark):
    df = spark.createDataFrame([(1, "x"), (2, " 　 "), (3, ""), (4, None)], "id int, text string")
    assert sorted(r.id for r in filters.filter_nonblank(df).collect()) == [1]
    assert sorted(r.id for r in filters.filter_truthy(df).collect()) == [1, 2]


def test_fix_mojibake(one_col):
    good = ["gęś", "zażółć gęślą jaźń", "café", "plain", "Łódź — „cytat”"]
    latin = [g.encode("utf-8").decode("latin-1") for g in good]
    cp1252 = [g.encode("utf-8").decode("cp1252", errors="strict") for g in ["gęś", "zażółć"]]
    assert one_col(TX.fix_mojibake, latin) == good
    assert one_col(TX.fix_mojibake, cp1252) == ["gęś", "zażółć"]
    assert one_col(TX.fix_mojibake, good) == good


def misread(text, page):
    """UTF-8 bytes read by a page, bytes without a character as themselves."""
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in text.encode())


def test_fix_mojibake_in_mixed_text(one_col):
    bad = "zażółć gęślą jaźń „cytat”"
    sound = "Łódź i PÓŁ — "
    for page in ("latin-1", "cp1252", "cp1250"):
        assert one_col(TX.fix_mojibake, [sound + misread(bad, page), misread(bad, page)]) == [sound + bad, bad]
    both = misread("gęś", "cp1252") + " 中 " + misread("łódź", "cp1250")
    assert one_col(TX.fix_mojibake, [both, None, ""]) == ["gęś 中 łódź", None, ""]


def test_fix_mojibake_leaves_sound_text(one_col):
    sound = ["„Ä“", "PÓŁ RÓŻY SPÓŁKA", "«CAFÉ» 中", "Äpfel „Ä“ und Ä…",
             "BĂŞESCU Ăsta", "â î ș", "😀 Â"]
    assert one_col(TX.fix_mojibake, sound) == sound
    one_letter_alone = "Äpfel, " + misread("gęś ś", "cp1252") + " 中"  # what the sound letter begins stays, the rest is repaired
    assert one_col(TX.fix_mojibake, [one_letter_alone]) == ["Äpfel, gÄ™ś ś 中"]


def test_fix_mojibake_is_one_arrow_call(spark):
    """Each repair is one Arrow call on the rows with other than ASCII, not regular expressions nested in lambdas."""
    plan = spark.range(1).select(TX.fix_mojibake(F.col("id").cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan and "translate" not in plan


def test_fix_mojibake_broken_utf8_and_controls(spark):
    rows = spark.sql("select decode(x, 'ISO-8859-1') t from values (x'C485'), (x'41C485E2'), (x'E28094'), (x'7F'), (x'C3') as v(x)")
    assert [r[0] for r in rows.select(TX.fix_mojibake(F.col("t"))).collect()] == ["\u0105", "A\u00c4\x85\u00e2", "\u2014", "\x7f", "\u00c3"]
    raw = spark.sql("select cast(x'61C3FF' as string) t").select(TX.fix_mojibake(F.col("t")).cast("binary").alias("t"))
    assert bytes(raw.first().t) == b"a\xc3\xff"


def test_blank_like_every_run_replaced(spark):
    texts = [None, "", " ", "  ", "a b", " a", "\u3000", "a\u3000 b\xa0", "\n\n", "\x1c x", "\u00e9", "\t\x85 \u2028"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert rows.where((F.coalesce(F.regexp_replace("t", TX.WS_RUN, ""), F.lit("")) == "") != TX.is_blank(F.col("t"))).collect() == []
    assert [r.t for r in rows.where(~TX.is_blank(F.col("t"))).collect()] == ["a b", " a", "a\u3000 b\xa0", "\x1c x", "\u00e9"]


def test_nfc_gate_is_a_plain_class_and_loses_nothing(spark):
    """The complement of a class is far slower to search for; every character that NFC changes must pass the gate."""
    assert not TX.NFC_GATE.startswith("[^")
    rows = spark.range(0x110000).where("id not between 55296 and 57343").select("id", F.expr(
        "decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("t"))
    passed = {r.id for r in rows.where(F.col("t").rlike(TX.NFC_GATE)).select("id").collect()}
    assert passed >= {i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and unicodedata.normalize("NFC", chr(i)) != chr(i)}
    old = [*range(0x300), *range(0x2002, 0x2070), *range(0x20A0, 0x20D0)]
    assert passed == set(range(0x110000)) - set(range(0xD800, 0xE000)) - set(old)


def test_fix_mojibake_long_texts(one_col):
    bad = misread("ś", "cp1250")
    assert one_col(TX.fix_mojibake, ["中" + bad * 200_000, "x" * 300_000 + "Ĺ" * 5]) == ["中" + "ś" * 200_000, "x" * 300_000 + "Ĺ" * 5]
