import datetime
import re

from pyspark.sql import functions as F

from quarry.llm import op7_pii as P
from tests.llm import edge


def run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id int, text string, pii string")
    return [(r.text, [tuple(h) for h in r.pii]) for r in P.pseudonymize(df, **kw).orderBy("doc_id").collect()]


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        s += n - 9 * (n > 9)
    return s % 10 == 0


def shape(x):
    return re.sub("[0-9]", "9", x)


def test_formats_stay_and_values_stay_linked(spark):
    texts = ["card 4041894974608795, again 4041 8949 7460 8795.", "4041894974608795", "+1 (980) 555-6268 and +49 30 901820",
             "ip 10.0.0.255 ssn 078-05-1120", "2024-02-29 12/31/1999 31.12.1999 1/2/2020", "mail ab.42@mail8.example.com."]
    got = run(spark, texts)
    for (text, hits), before in zip(got, texts):
        for kind, a, b in hits:
            assert a in before and b in text and a not in text
            if kind != "email":
                assert a != b
            if kind in ("card", "phone", "ssn"):
                assert shape(a) == shape(b)
            if kind == "card":
                assert luhn(re.sub(r"\D", "", b)) and a[0] == b[0]
    assert [len(h) for _, h in got] == [2, 1, 2, 2, 4, 1]
    assert re.sub(r"\D", "", got[0][1][0][2]) == re.sub(r"\D", "", got[0][1][1][2]) == got[1][1][0][2]
    iso, us, eu, short = [h[2] for h in got[4][1]]
    days = [datetime.date.fromisoformat(iso), datetime.datetime.strptime(us, "%m/%d/%Y").date(), datetime.datetime.strptime(eu, "%d.%m.%Y").date()]
    assert days[1] == days[2] and datetime.datetime.strptime(short, "%m/%d/%Y")
    assert run(spark, texts, key="other") != got


def test_what_is_not_valid_stays(spark):
    texts = ["card 4041894974608796", "ip 300.1.1.1 and 1.2.3", "ssn 000-12-1234 666-12-1234", "2023-02-29 99.99.2020", "+12", "v 1.2.3.4.5.6",
             None, "", "x" * 100_000 + " 12"]
    assert run(spark, texts) == [(t, []) for t in texts]


def test_permutations_are_one_to_one(spark):
    days = spark.range(0, 292_194, 97).select(F.date_add(F.lit(P.FIRST_DAY).cast("date"), F.col("id").cast("int")).cast("string").alias("x"))
    ssns = spark.range(0, 3000).select(F.format_string("%03d-%02d-%04d", F.col("id") % 898 + F.when(F.col("id") % 898 >= 665, 2).otherwise(1),
                                                       F.col("id") % 99 + 1, F.col("id") % 9999 + 1).alias("x")).distinct()
    ips = spark.range(0, 3000).select(F.concat_ws(".", *[((F.col("id") * m) % 256).cast("string") for m in (1, 7, 31, 3)]).alias("x")).distinct()
    for df in (days, ssns, ips):
        out = df.select("x", P.pseudonym(F.col("x"), P.kind_of(F.col("x"))).alias("y"), P.kind_of(F.col("x")).alias("k"))
        out = out.withColumn("again", P.kind_of(F.col("y")))
        n, distinct, valid = out.agg(F.count("x"), F.countDistinct("y"), F.count_if(F.col("k") == F.col("again"))).first()
        assert n == distinct == valid


def test_small_domain_is_a_permutation(spark):
    pair = P.feistel("t", F.col("id") % 12, F.floor(F.col("id") / 12), 12, 7)
    got = [tuple(r[0]) for r in spark.range(84).select(pair).collect()]
    assert sorted(got) == [(a, b) for a in range(12) for b in range(7)]


def test_edge_rows(spark):
    assert edge.count(P.pseudonymize(edge.docs(spark))) == len(edge.rows())
    assert P.pseudonymize(edge.empty(spark)).collect() == []


def test_values_next_to_numbers_are_found(spark):
    """(kind, value) of texts where a value runs into another number."""
    card, other = "4111 1111 1111 1111", "5500 0000 0000 0004"
    want = {
        "+1 (826) 555-4081 190.137.223.20": [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.20")],
        "+49 30 901820 190.137.223.20": [("phone", "+49 30 901820"), ("ip", "190.137.223.20")],
        "+49 30 901820 2024-02-29": [("phone", "+49 30 901820"), ("date", "2024-02-29")],
        f"+49 30 901820 {card}": [("phone", "+49 30 901820"), ("card", card)],
        "+1 (843) 555-7672 42": [("phone", "+1 (843) 555-7672")],
        f"{card} 03/26": [("card", card)],
        f"{card} 123": [("card", card)],
        f"12 {card}": [("card", card)],
        f"12 34 {card} 77": [("card", card)],
        f"{card} {other}": [("card", card), ("card", other)],
        f"{card} 2024-02-29": [("card", card), ("date", "2024-02-29")],
        f"{card} 10.0.0.1": [("card", card), ("ip", "10.0.0.1")],
        "3782 822463 10005 99": [("card", "3782 822463 10005")],
        "no.4111111111111111": [("card", "4111111111111111")],
    }
    for (text, hits), before in zip(run(spark, list(want)), want):
        assert [(k, a) for k, a, _ in hits] == want[before], before
        for _, a, b in hits:
            before = before.replace(a, b)
        assert text == before


def test_long_values(spark):
    """Patterns with repeated groups take any number of repeats without the regex engine running out of stack."""
    texts = ["x@b" + ".c" * 200_000, "write to a@b" + "-c" * 200_000 + ".de now", "+1" + " 234" * 100_000, "4" * 200_000, "1." * 200_000]
    got = run(spark, texts)
    assert got[0][0].endswith("@example.invalid") and got[1][0].endswith("@example.invalid now") and len(got) == 5


def test_spellings_of_a_phone_stay_linked(spark):
    """One number has one pseudonym, however it is written; the country code stays."""
    spellings = [["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 (20) 7946 0958"], ["+1 (980) 555-6268", "+19805556268", "+1.980.555.6268"],
                 ["+351 21 123 4567", "+351211234567"], ["+7 495 123 4567", "+74951234567"]]
    got = run(spark, [x for group in spellings for x in group])
    at = 0
    for group, code in zip(spellings, ("44", "1", "351", "7")):
        digits = [re.sub(r"\D", "", got[at + i][1][0][2]) for i in range(len(group))]
        assert [shape(got[at + i][1][0][2]) for i in range(len(group))] == [shape(x) for x in group]
        assert len(set(digits)) == 1 and digits[0].startswith(code) and digits[0] != re.sub(r"\D", "", group[0])
        at += len(group)
